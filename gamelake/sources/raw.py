"""Raw landing zone: per-player monthly feed documents, roster snapshots and
archive lists as JSON files; readers with declared schemas, writers, and the
path helpers built on Hadoop's FileSystem.

Layout (partition directories, so month selection prunes files):
``<root>/player_games/year=YYYY/month=MM/<one document per file>``.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake import schemas as SC
from gamelake.functions import exprs as X
from gamelake.session import configure


# --- file system helpers ------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of all files under ``path`` (none if it does not exist)."""
    return [f.getPath().toString() for f in _files(spark, path)]


def file_marks(spark: SparkSession, path: str) -> list[str]:
    """Name, size and time of all files under ``path``."""
    return [f"{f.getPath().toString()} {f.getLen()} {f.getModificationTime()}" for f in _files(spark, path)]


def _files(spark: SparkSession, path: str) -> list:
    fs, p = _fs(spark, path)
    found = []
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            found.append(files.next())
    return found


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


_PUBLISH_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def publish(spark: SparkSession, path: str, write) -> str:
    """Write once to ``path``: ``write(tmp)`` goes to a private sibling that is
    renamed into place, so readers never see a half-written tree. Callers in
    one driver serialise per path; a copy another driver published first wins."""
    with _LOCKS_GUARD:
        lock = _PUBLISH_LOCKS.setdefault(path, threading.Lock())
    with lock:
        if exists(spark, path):
            return path
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        write(tmp)
        if exists(spark, path) or not rename(spark, tmp, path):
            delete(spark, tmp)
    return path


# --- file index of the landing zone -----------------------------------------------
def _subdirs(fs, path, key: str) -> dict[str, object]:
    """Value -> directory of the ``<key>=<value>`` children."""
    found = {}
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{key}="):
            found[name.split("=", 1)[1]] = st.getPath()
    return found


def month_dirs(spark: SparkSession, root: str) -> dict[str, str]:
    """Month key -> directory of the months that hold a file, from the two
    directory levels alone: a listing of the years, one of each year, and the
    first file of each month. No document is listed further or opened."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return {}
    out = {}
    for year, at_year in _subdirs(fs, p, "year").items():
        for month, at in _subdirs(fs, at_year, "month").items():
            if fs.listFiles(at, True).hasNext():
                out[f"{year}-{month}"] = at.toString()
    return dict(sorted(out.items()))


#: Rows of ``read_feed``: the document with the file it came from.
FEED_ROWS = SC.struct([*[(f.name, f.dataType) for f in SC.FEED_FILE.fields if f.name not in ("year", "month")],
                       ("year", SC.S), ("month", SC.S), ("feed", SC.S), ("raw_key", SC.S)])


def closed(document: T.StructType) -> T.StructType:
    """``document`` with its games as JSON texts."""
    return SC.struct([(f.name, SC.SA if f.name == "games" else f.dataType) for f in document.fields])


FILE_INDEX = "year string, month string, feed string, path string, length long, modified timestamp"


def file_index(spark: SparkSession, root: str, months: Sequence[str] | None = None) -> DataFrame:
    """One row per feed document (year, month, feed, path, length, modified),
    listed by Spark's parallel file listing. Only the selected months'
    directories are listed, and no document is read."""
    configure(spark)
    dirs = month_dirs(spark, root)
    paths = [dirs[m] for m in (sorted(set(months)) if months else dirs) if m in dirs]
    if not paths:
        return spark.createDataFrame([], FILE_INDEX)
    files = spark.read.format("binaryFile").option("basePath", root).load(paths)
    return files.select("year", "month", "feed", "path", "length", F.col("modificationTime").alias("modified"))


# --- A1 feed documents ----------------------------------------------------------
def read_feed(spark: SparkSession, root: str, months: Sequence[str] | None = None, opened: bool = True) -> DataFrame:
    """All feed documents under ``root`` (``.../player_games``); ``raw_key`` is
    the file path. One document per file, so each file is one JSON value; a
    file that is none (cut short, say) fails the job instead of passing as an
    empty document. With a month list only those months' directories are
    listed; a month without documents gives no rows. A document without a
    ``game_count`` gets the length of its games.

    ``opened=False`` leaves each game its JSON text, a fraction of the memory
    of its fields; ``bronze.explode_feed`` opens them one at a time."""
    configure(spark)
    rows, document = (FEED_ROWS, SC.FEED_FILE) if opened else (closed(FEED_ROWS), closed(SC.FEED_FILE))
    paths = [root]
    if months:
        dirs = month_dirs(spark, root)
        paths = [dirs[m] for m in sorted(set(months)) if m in dirs]
        if not paths:
            return spark.createDataFrame([], rows)
    df = (spark.read.schema(document).option("multiLine", True).option("mode", "FAILFAST")
          .option("basePath", root).option("recursiveFileLookup", False).json(paths))
    df = df.withColumn("raw_key", F.col("_metadata.file_path"))
    return df.withColumn("game_count", F.coalesce("game_count", F.size("games")))


#: Documents that a writer task keeps open at a time, so that whole documents are not sorted (and spilled) before
#: they are written. A task with more of them sorts the rest.
OPEN_DOCUMENTS = 256
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over a fixed number of tasks (a by-number repartition, which AQE does not coalesce)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Documents are collected from sorted rows, group by group: an object hash aggregate holds a task's documents in a
#: map and, where it falls back to sorting, sorts whole documents once more for its second step.
ONE_BY_ONE = {"spark.sql.execution.useObjectHashAggregateExec": "false", "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def one_by_one(spark: SparkSession) -> Iterator[None]:
    """Documents written within are made one after the other: a task sorts its plain rows (which may spill) and
    collects one document at a time, instead of holding or sorting all of its documents."""
    with settings(spark, ONE_BY_ONE):
        yield


def write_feed(docs: DataFrame, root: str, mode: str = "overwrite", dealt: bool = False) -> None:
    """Documents -> one gzipped JSON file each under year=/month=/feed=<file name>.

    ``docs`` needs ``feed`` (the file's name) plus the document fields.
    ``dealt``: the documents lie spread over tasks already (``spread``), each
    (year, month, feed) once, and need no shuffle of whole documents.
    """
    cols = ["username", "year", "month", "month_key", "game_count", "games", "feed"]
    # One file per document: without a fixed number of writer tasks AQE may
    # coalesce them into one, which would create every file in turn.
    docs = docs.select(*cols) if dealt else spread(docs.select(*cols), "year", "month", "feed")
    # Partition columns leave the file body and come back from the path.
    with settings(docs.sparkSession, {OPEN_FILES: str(OPEN_DOCUMENTS)}), one_by_one(docs.sparkSession):
        docs.write.mode(mode).partitionBy("year", "month", "feed").option("compression", "gzip").json(root)


def game_lines(rows: DataFrame, doc: Sequence[str], feed: Mapping[str, Column], username: Column, game: Column, order: Sequence[str]) -> DataFrame:
    """Rows of games, dealt by ``doc`` (``spread``) -> the lines of their documents, in order: (year, month, feed, value).

    ``doc``: the columns that tell documents apart; ``feed``: year, month and feed, made of them; ``username`` and
    ``game`` (a struct) are made of a row, ``order`` sorts the games of a document. A document's username is null
    where a game lacks it. Its first line opens it, its last closes it, so a task sorts plain rows (which may
    spill) and holds no document."""
    rows = rows.withColumn("_user", username)
    # As the writer would name the directories, but never null: then the rows need no second sort.
    rows = rows.withColumns({c: F.coalesce(F.nullif(feed[c], F.lit("")), F.lit(SC.NO_VALUE)) for c in ("year", "month", "feed")})
    at = Window.partitionBy("year", "month", "feed", *doc).orderBy(*order)
    whole = at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"_pos": F.row_number().over(at), "_n": F.count(F.lit(1)).over(whole),
                             "_named": F.count("_user").over(whole), "_user": F.max("_user").over(whole)})
    head = F.to_json(F.struct(F.when(F.col("_named") == F.col("_n"), F.col("_user")).alias("username"),
                              F.concat_ws("-", *[F.nullif(F.col(c), F.lit(SC.NO_VALUE)) for c in ("year", "month")]).alias("month_key"),
                              F.col("_n").cast("int").alias("game_count")))
    value = F.concat(F.when(F.col("_pos") == 1, F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"games":[\n'))).otherwise(""),
                     F.to_json(game), F.when(F.col("_pos") == F.col("_n"), "\n]}").otherwise(","))
    return rows.select("year", "month", "feed", value.alias("value"))


def write_lines(lines: DataFrame, root: str, mode: str = "overwrite") -> None:
    """``game_lines`` -> the files of ``write_feed``: one gzipped JSON document each, a game a line. The rows lie
    in the order of their files, so one file is open at a time. Compressed fast: closer compression took as much
    CPU time as all the rest of the writing."""
    with settings(lines.sparkSession, {OPEN_FILES: "0"}):
        (lines.write.mode(mode).partitionBy("year", "month", "feed").option("compression", "gzip")
         .option("zlib.compress.level", "BEST_SPEED").text(root))


# --- A2 / A3 roster and archive snapshots ----------------------------------------------
def read_rosters(spark: SparkSession, root: str) -> DataFrame:
    configure(spark)
    return (spark.read.schema(SC.ROSTER_DOC).option("multiLine", True).option("mode", "FAILFAST").json(root)
            .withColumn("raw_key", F.col("_metadata.file_path")))


def read_archive_lists(spark: SparkSession, root: str) -> DataFrame:
    configure(spark)
    return (spark.read.schema(SC.ARCHIVE_DOC).option("multiLine", True).option("mode", "FAILFAST").json(root)
            .withColumn("raw_key", F.col("_metadata.file_path")))


ARCHIVE_DAILY = r"/(\d{4}-\d{2}-\d{2})\.json$"
ARCHIVE_MONTHLY = r"/(\d{4})/(\d{2})\.json$"


def archive_key_rank(key: str | Column = "raw_key") -> Column:
    """(rank, sort text) of an archive-list file: dated daily file (2) beats a
    legacy monthly file (1) beats anything else (0, compared by key)."""
    k = X.col(key)
    daily = F.regexp_extract(k, ARCHIVE_DAILY, 1)
    y, m = F.regexp_extract(k, ARCHIVE_MONTHLY, 1), F.regexp_extract(k, ARCHIVE_MONTHLY, 2)
    return (F.when(daily != "", F.struct(F.lit(2).alias("rank"), daily.alias("v")))
            .when(y != "", F.struct(F.lit(1).alias("rank"), F.concat(y, F.lit("-"), m).alias("v")))
            .otherwise(F.struct(F.lit(0).alias("rank"), k.alias("v"))))


def latest_archive_list(lists: DataFrame, key: str = "raw_key", user: str = "username") -> DataFrame:
    """A3: per player, the archive-list document with the highest key rank.

    The ranks alone are aggregated; the winners' lists follow by a semi join
    on the key. A key names one document (a file), so a player gets one row."""
    best = (lists.filter(F.col(user).isNotNull()).groupBy(user).agg(F.max(F.struct(archive_key_rank(key).alias("r"), F.col(key).alias("k"))).alias("_b"))
            .select(user, F.col("_b.k").alias(key)))
    return lists.join(best, [user, key], "left_semi").select(user, *[c for c in lists.columns if c != user])


# --- A13 ------------------------------------------------------------------------
def months_available(spark: SparkSession, root: str) -> DataFrame:
    """Months that hold raw documents, by their directories (no document is opened)."""
    return spark.createDataFrame([(m,) for m in month_dirs(spark, root)], "month_key string")


def available_months(feed_paths: DataFrame, path: str = "raw_key") -> DataFrame:
    """Distinct year=/month= found in file paths, as sorted month keys."""
    m = F.regexp_extract(X.col(path), r"year=(\d{4})/month=(\d{2})/", 0)
    y = F.regexp_extract(X.col(path), r"year=(\d{4})/month=(\d{2})/", 1)
    mo = F.regexp_extract(X.col(path), r"year=(\d{4})/month=(\d{2})/", 2)
    return (feed_paths.select(F.when(m != "", F.concat(y, F.lit("-"), mo)).alias("month_key"))
            .filter(F.col("month_key").isNotNull()).distinct())


def games_of(ranked: str | Column) -> Column:
    """Sorted (pos, g) structs -> the document's games; ``accuracies`` text becomes the JSON value again."""
    return F.transform(X.col(ranked), lambda x: x["g"].withField("accuracies", F.try_parse_json(x["g"]["accuracies"])))


# --- A12 ---------------------------------------------------------------------------
def packed_lines(occurrences: DataFrame, feed_col: str = "source_username") -> DataFrame:
    """``pack_feed`` for documents of any length: the lines of the same documents, for ``write_lines``."""
    game_fields = [f.name for f in SC.GAME.fields]
    rows = occurrences.select(F.col("year").alias("_year"), F.col("month").alias("_month"), F.col(feed_col).alias("_feed"), "pos", *game_fields)
    game = F.struct(*[F.try_parse_json(f).alias(f) if f == "accuracies" else F.col(f) for f in game_fields])
    feed = {c: F.col(f"_{c}") for c in ("year", "month", "feed")}
    doc = [f"_{c}" for c in feed]
    return game_lines(spread(rows, *doc), doc, feed, F.col("_feed"), game, ["pos", *game_fields])


def pack_feed(occurrences: DataFrame, feed_col: str = "source_username") -> DataFrame:
    """Occurrences (year, month, <feed_col>, pos, game fields) -> one document
    per player-month with the games in position order.

    A document is one player's month, so its size is bounded by the games one
    player can play in a month. Games are dealt by document first: lists
    collected ahead of the shuffle would be no fewer, and cannot spill."""
    game_fields = [f.name for f in SC.GAME.fields]
    rows = occurrences.select("year", "month", feed_col, "pos", *game_fields)
    docs = spread(rows, "year", "month", feed_col).groupBy("year", "month", feed_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos"), F.struct(*game_fields).alias("g")))).alias("_games"))
    return docs.select(
        F.col(feed_col).alias("username"), "year", "month", F.concat_ws("-", "year", "month").alias("month_key"),
        F.size("_games").cast("int").alias("game_count"), games_of("_games").alias("games"),
        F.col(feed_col).alias("feed"))
