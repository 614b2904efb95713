"""WARC archives: write whole-file gzip streams, normalise them, read them back by offset.

The normaliser inflates a monolithic gzip stream once, rewrites every record
as a gzip member of its own and puts a sidecar index of offsets beside the new
archive, so that any record can be read alone. Files are written by tasks to
the session's shared folder; only names that a finished task returned are
used, so a task that runs again leaves at most an unused file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import shared_path, small_batches, written

#: Raw bytes after which a task begins another archive.
ROLL_BYTES = 256 << 20
CHUNK = 1 << 20
STREAM_LEVEL, MEMBER_LEVEL = 1, 4
DATE = "2024-01-01T00:00:00Z"
#: Pages per archive that the number of write tasks aims at.
ARCHIVE_PAGES = 4000

_FILES = pa.schema([("path", pa.string()), ("records", pa.int64())])
_PAGES = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64())])


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int, url: str, payload: bytes | None, refers_to: int | None, size: int, sha1: str) -> bytes:
    """A response record with the payload, or a revisit record that refers to one."""
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if payload is None else b"response"),
            f"WARC-Record-ID: <urn:page:{page_id}>".encode(), f"WARC-Date: {DATE}".encode(),
            b"WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A").encode(),
            f"WARC-Payload-Digest: sha1:{sha1}".encode(), f"X-Payload-Length: {size}".encode()]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if payload is None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>".encode()]
    else:
        body += payload
    head += [b"Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields in lower case, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode().strip().lower()] = value.decode().strip()
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def records_of(stream):
    """Whole records from an iterator of inflated byte chunks."""
    held, at = bytearray(), 0
    for chunk in stream:
        held += chunk
        while True:
            stop = held.find(b"\r\n\r\n", at)
            if stop < 0:
                break
            length = None
            for line in bytes(held[at:stop]).split(b"\r\n"):
                if line[:15].lower() == b"content-length:":
                    length = int(line[15:])
            end = stop + 4 + length + 4
            if len(held) < end:
                break
            yield bytes(held[at:end])
            at = end
        if at > CHUNK:
            del held[:at]
            at = 0
    if held[at:].strip():
        raise ValueError("the archive ends within a record")


def inflated(source):
    """Chunks of a gzip file, read once from start to end, one or more members."""
    box = zlib.decompressobj(31)
    while raw := source.read(CHUNK):
        while raw:
            yield box.decompress(raw)
            raw = box.unused_data if box.eof else b""
            if box.eof:
                box = zlib.decompressobj(31)


def _write_streams(folder: str):
    def run(batches):
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        sink, count, raw, path, box = None, 0, 0, None, None
        for batch in batches:
            for page_id, url, html, refers, size, sha in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    sink, count, raw = system.open_output_stream(f"{base}/{path}", compression=None), 0, 0
                    box = zlib.compressobj(STREAM_LEVEL, zlib.DEFLATED, 31)
                payload = None if refers is not None else (html or "").encode("utf-8")
                sha32 = base64.b32encode(bytes.fromhex(sha)).decode()
                one = record(page_id, url, payload, refers, size, sha32)
                sink.write(box.compress(one))
                count, raw = count + 1, raw + len(one)
                if raw >= ROLL_BYTES:
                    sink.write(box.flush())
                    sink.close()
                    sink = None
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], schema=_FILES)
        if sink is not None:
            sink.write(box.flush())
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], schema=_FILES)

    return run


def _rewrite(source_folder: str, folder: str):
    def run(batches):
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        _, origin = _filesystem(source_folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, at, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                with system.open_input_stream(f"{origin}/{name}", compression=None) as source, \
                        system.open_output_stream(f"{base}/{out}", compression=None) as sink, \
                        system.open_output_stream(f"{base}/{out}.idx", compression=None) as index:
                    for one in records_of(inflated(source)):
                        box = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
                        member = box.compress(one) + box.flush()
                        sink.write(member)
                        fields, _ = parse(one)
                        index.write((json.dumps({"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": at,
                                                 "length": len(member)}) + "\n").encode())
                        at, count = at + len(member), count + 1
                yield pa.RecordBatch.from_arrays([pa.array([out]), pa.array([count], pa.int64())], schema=_FILES)

    return run


def _page_number(urn: str | None) -> int | None:
    return int(urn.strip("<>").rpartition(":")[2]) if urn else None


def _read(folder: str):
    def run(batches):
        system, base = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{base}/{name}") as source, \
                        system.open_input_stream(f"{base}/{name}.idx", compression=None) as index:
                    held, out = b"", []
                    while raw := index.read(CHUNK):
                        *lines, held = (held + raw).split(b"\n")
                        for entry in map(json.loads, lines):
                            fields, payload = parse(zlib.decompress(source.read_at(entry["length"], entry["offset"]), 31))
                            if fields["warc-record-id"] != entry["id"]:
                                raise ValueError(f"{name}: the index points to another record")
                            sha = fields["warc-payload-digest"].partition(":")[2]
                            if entry["type"] == "response" and (digest(payload) != sha or len(payload) != int(fields["x-payload-length"])):
                                raise ValueError(f"{name}: payload of {entry['id']} is damaged")
                            out.append((_page_number(entry["id"]), int(fields["x-payload-length"]), sha, entry["type"],
                                        _page_number(fields.get("warc-refers-to"))))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _PAGES)] if out else
                                                         [pa.array([], t.type) for t in _PAGES], schema=_PAGES)
                        out = []

    return run


def decide(pages: DataFrame, least_bytes: int = 0, tasks: int | None = None) -> DataFrame:
    """(page_id, url, html, refers_to, size, sha1): refers_to set and html null for revisits.

    Of equal payloads of at least ``least_bytes`` the smallest page_id is the
    response. Only digests are grouped; payloads are dealt by page_id and
    digest, with ``tasks`` once and for all: the join and the writers use the same deal.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).filter("page_id is not null")
    marks = written(own.select("page_id", F.octet_length("html").cast("long").alias("size"), F.sha1("html").alias("sha1")), "digests")
    first = marks.filter(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    copies = (marks.join(first.filter("n > 1").select("sha1", "size", "first"), ["sha1", "size"])
              .filter("first <> page_id").select(F.col("page_id").alias("id"), F.col("first").alias("refers_to"), "sha1").distinct())
    keyed = own.select("page_id", "url", "html", F.octet_length("html").cast("long").alias("size"), F.sha1("html").alias("sha1"))
    if tasks is not None:
        keyed = keyed.repartition(tasks, "page_id", "sha1")
    joined = keyed.join(copies.withColumnRenamed("sha1", "same"), (F.col("page_id") == F.col("id")) & (F.col("sha1") == F.col("same")), "left")
    return joined.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "refers_to", "size", "sha1")


def write_streams(records: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """Monolithic archives of ``decide``'s rows in ``folder``: (path, records).
    Without ``tasks`` the rows are archived as they are dealt."""
    small_batches(records.sparkSession, 500)
    dealt = records.select("page_id", "url", "html", "refers_to", "size", "sha1")
    if tasks is not None:
        dealt = dealt.repartition(tasks, F.xxhash64("page_id", "sha1"))
    return written(dealt.mapInArrow(_write_streams(folder), "path string, records long"), "streams")


def normalise(files: DataFrame, source: str, folder: str) -> DataFrame:
    """One gzip member per record and a sidecar ``.idx`` per archive: (path, records)."""
    many = max(1, files.count())
    return written(files.select("path").repartition(many, "path").mapInArrow(_rewrite(source, folder), "path string, records long"), "archives")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), each record read by its index entry."""
    many = max(1, files.count())
    return files.select("path").repartition(many, "path").mapInArrow(
        _read(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` (page_id, url, html), normalise, and read everything back.

    Null html is an empty payload, a null url an empty one. Rows with a null
    page_id have no record id and are left out. Rows that repeat a page_id
    are a record each. Any payload length works: a record is held whole by
    one task. An empty table gives no archives and no rows; extra columns are
    ignored.
    """
    spark = pages.sparkSession
    tasks = max(1, -(-pages.count() // ARCHIVE_PAGES), spark.sparkContext.defaultParallelism)
    raw, folder = shared_path(spark, "warc-streams"), shared_path(spark, "warc")
    streams = write_streams(decide(pages, least_bytes, tasks), raw)
    return read_archives(normalise(streams, raw, folder), folder)
