"""WARC: exact round trip, one member per record, sidecar offsets, revisits."""

import gzip
import hashlib
import io
import json
import zlib
from base64 import b32encode

import pytest

from gamelake.llm import warc


def plain(rows, least=0):
    data = {p: (h or "").encode() for p, h in rows}
    first = {}
    for p in sorted(data):
        first.setdefault(data[p], p)
    out = {}
    for p, b in data.items():
        same = first[b] if len(b) >= least else p
        out[p] = (len(b), b32encode(hashlib.sha1(b).digest()).decode(), "response" if same == p else "revisit", None if same == p else same)
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_round_trip_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r["page_id"], r["html"]) for r in pages.select("page_id", "html").collect()]
    assert got(warc.round_trip(pages)) == plain(rows)


def test_edge_rows(spark):
    long = "<p>é</p>" * 400000
    rows = [(1, "same"), (2, None), (3, "same"), (4, ""), (5, "a\r\n\r\nContent-Length: 3\r\n\r\nWARC/1.1"), (6, long), (7, long), (8, "x\x00y")]
    df = spark.createDataFrame([(p, None if p == 5 else f"http://h/{p}\r\nX: 1", h, "z", 9) for p, h in rows],
                               "page_id long, url string, html string, sha1 string, size int")
    assert got(warc.round_trip(df)) == plain(rows)
    assert got(warc.round_trip(df, least_bytes=5)) == plain(rows, 5)
    again = warc.round_trip(df.unionByName(df.filter("page_id = 8"))).filter("page_id = 8").collect()
    assert len(again) == 2 and {r["record_type"] for r in again} == {"response"}
    assert warc.round_trip(df.limit(0)).count() == 0
    assert warc.round_trip(spark.createDataFrame([(None, "u", "h")], "page_id long, url string, html string")).count() == 0


def test_normaliser_splits_a_monolithic_stream(spark, tmp_path):
    records = [warc.record(i, f"http://h/{i}", f"body {i}".encode() * i, None, len(f"body {i}") * i, "S") for i in range(1, 6)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    files = spark.createDataFrame([("a.warc.gz", 5)], "path string, records long")
    out = warc.normalise(files, f"file://{tmp_path}/in", f"file://{tmp_path}/out").collect()
    assert [r["records"] for r in out] == [5]
    made = (tmp_path / "out" / out[0]["path"]).read_bytes()
    index = [json.loads(line) for line in (tmp_path / "out" / (out[0]["path"] + ".idx")).read_text().splitlines()]
    assert [zlib.decompress(made[e["offset"]: e["offset"] + e["length"]], 31) for e in index] == records
    assert b"".join(records) == gzip.decompress(made)


def test_cut_stream_is_an_error():
    whole = warc.record(1, "u", b"x" * 100, None, 100, "S")
    packed = gzip.compress(whole[:-30])
    with pytest.raises(ValueError):
        list(warc.records_of(warc.inflated(io.BytesIO(packed))))
    two = gzip.compress(whole) + gzip.compress(whole)
    assert list(warc.records_of(warc.inflated(io.BytesIO(two)))) == [whole, whole]
