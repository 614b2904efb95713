"""Tables behind a pointer: each version is one small file, put in place atomically.

Layout under a table's root::

    data=<id>/...            files of one write, never changed afterwards
    _commits/<version>       JSON: part name -> folder under the root

A writer names the version it read and adds the next one; a rename that
cannot replace a file makes sure that only one writer does, so an update
based on an older version fails instead of undoing a newer one. A version
may keep parts of the one before it (a partial rebuild). Readers resolve the
newest version once and then read files that nobody touches: the folders of
the version before stay until the commit after the next.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gamelake.session import configure
from gamelake.sources import raw

COMMITS = "_commits"


class StaleVersion(RuntimeError):
    """Another writer committed after the version this one had read."""


@dataclass(frozen=True)
class Version:
    """A committed version; number 0 is the state before the first commit."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)


def _commit_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{number:012d}"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the version files at hand, ascending."""
    fs, p = raw._fs(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def version(spark: SparkSession, root: str, number: int) -> Version:
    fs, p = raw._fs(spark, _commit_path(root, number))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(number, json.loads(text)["parts"])


def head(spark: SparkSession, root: str) -> Version:
    """The newest version (number 0 without parts where there is none)."""
    for again in (True, True, False):
        found = numbers(spark, root)
        if not found:
            return Version()
        try:
            return version(spark, root, found[-1])
        except Exception:  # pruned since it was listed: newer ones are there
            if not again or raw.exists(spark, _commit_path(root, found[-1])):
                raise
    return Version()


def folder() -> str:
    """Name of a new data folder."""
    return f"data={uuid.uuid4().hex}"


_IN_DRIVER = threading.Lock()


def commit(spark: SparkSession, root: str, seen: Version, parts: dict[str, str]) -> Version:
    """Make ``parts`` the version after ``seen``; ``StaleVersion`` if there is one already."""
    sc = spark.sparkContext
    jvm = sc._jvm
    target = _commit_path(root, seen.number + 1)
    draft = f"{root.rstrip('/')}/{COMMITS}/.draft-{uuid.uuid4().hex}"
    fs, p = raw._fs(spark, draft)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps({"parts": parts}, sort_keys=True), "utf-8"))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    keep = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    with _IN_DRIVER:  # local file systems check and rename in two steps
        # The file of the version read may be gone only if later ones were committed.
        newer = [n for n in numbers(spark, root) if n > seen.number]
        try:
            if newer:
                raise StaleVersion(f"{root}: version {newer[-1]} was committed after version {seen.number}")
            files.rename(p, jvm.org.apache.hadoop.fs.Path(target), keep)
        except Exception as error:
            raw.delete(spark, draft)
            if isinstance(error, StaleVersion) or not raw.exists(spark, target):
                raise
            raise StaleVersion(f"{root}: version {seen.number + 1} was committed by another writer") from error
    return Version(seen.number + 1, dict(parts))


def prune(spark: SparkSession, root: str, current: Version) -> None:
    """Drop versions older than the one before ``current``, with the folders that no kept version names."""
    old = [n for n in numbers(spark, root) if n < current.number - 1]
    if not old:
        return
    kept = set(current.parts.values())
    if current.number - 1 in numbers(spark, root):
        kept |= set(version(spark, root, current.number - 1).parts.values())
    kept_tops = {f.split("/")[0] for f in kept}
    for n in old:
        for path in sorted(set(version(spark, root, n).parts.values()) - kept):
            top = path.split("/")[0]
            raw.delete(spark, f"{root.rstrip('/')}/{path if top in kept_tops else top}")
        raw.delete(spark, _commit_path(root, n))


def replace(df: DataFrame, root: str, part_col: str | None = None, only: Sequence[str] | None = None,
            seen: Version | None = None) -> Version:
    """Write ``df`` as the table's next version.

    Without ``part_col`` it is the whole table. With one, the rows are laid
    out by its values, and ``only`` (values) replaces just those parts: a
    listed part that has no rows any more goes, all others stay as they are.
    """
    spark = df.sparkSession
    configure(spark)
    seen = head(spark, root) if seen is None else seen
    name = folder()
    target = f"{root.rstrip('/')}/{name}"
    if part_col is None:
        df.write.option("partitionOverwriteMode", "static").parquet(target)
        parts = {"": name}
    else:
        out = df.hint("rebalance", part_col)
        out.write.option("partitionOverwriteMode", "static").partitionBy(part_col).parquet(target)
        fs, p = raw._fs(spark, target)
        dirs = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        written = {d.split("=", 1)[1]: f"{name}/{d}" for d in dirs if d.startswith(f"{part_col}=")}
        kept = {} if only is None else {k: v for k, v in seen.parts.items() if k not in set(only)}
        parts = kept | written
    try:
        done = commit(spark, root, seen, parts)
    except StaleVersion:
        raw.delete(spark, target)
        raise
    prune(spark, root, done)
    return done


def _plain(spark: SparkSession, root: str) -> bool:
    """Whether files of an older layout lie there, and not just a first write that is not committed yet."""
    fs, p = raw._fs(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return any(not n.startswith(("_", ".", "data=")) for n in names)


def read(spark: SparkSession, root: str, schema: T.StructType | None = None, at: Version | None = None) -> DataFrame:
    """The table at a version (the newest by default).

    A table never committed is read as plain files where there are any (an
    older layout); without files, or with no parts left, it is empty and needs ``schema``.
    """
    configure(spark)
    at = head(spark, root) if at is None else at
    if at.number == 0 and _plain(spark, root):
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(root)
    if not at.parts:
        if schema is None:
            raise FileNotFoundError(f"no table at {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("data", T.StringType())]))
    return reader.parquet(*[f"{root.rstrip('/')}/{p}" for p in at.parts.values()]).drop("data")
