"""Versioned storage of the control-state tables.

``read`` and ``commit`` handle the three tables (titles, players, index) as
one state: a commit writes them to a new folder and puts one version file in
place that names it (``snapshots``). The writer names the version it read;
if another run committed since, the save fails with ``StaleVersion`` and
nothing is lost. ``load`` and ``save`` keep a single table in ``version=``
folders. ``player_state`` is partitioned by title and ``player_index`` by a
two-letter username prefix. Missing tables load as empty frames with the
declared schema; missing fields of older versions get their defaults.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.operators import state as ST
from gamelake.session import configure
from gamelake.sources import raw, snapshots

TABLES = {
    "title_state": (SC.TITLE_STATE, []),
    "player_state": (SC.PLAYER_STATE, ["title"]),
    "player_index": (SC.PLAYER_INDEX, ["username_prefix"]),
}


def _dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/state/{table}"


def versions(spark: SparkSession, root: str, table: str) -> list[str]:
    fs, p = raw._fs(spark, _dir(root, table))
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(name.split("=", 1)[1])
    return sorted(out)


def defaults(table: str) -> dict:
    if table == "title_state":
        return {}
    if table == "player_state":
        return {"status": F.coalesce(F.col("status"), F.lit("active")),
                "has_current_month_archive": F.coalesce(F.col("has_current_month_archive"), F.lit(False)),
                "current_month_game_count": F.coalesce(F.col("current_month_game_count"), F.lit(0)),
                "backfill_pending": F.coalesce(F.col("backfill_pending"), F.lit(False)),
                "backfill_pending_count": F.coalesce(F.col("backfill_pending_count"), F.lit(0)),
                "player_index_key": F.coalesce(F.col("player_index_key"), ST.player_index_key("username"))}
    empty = F.array().cast("array<string>")
    return {c: F.coalesce(F.col(c), empty) for c in ("stored_months", "archive_months", "pending_backfill_months")}


def load(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Newest saved version, or an empty table with the declared schema."""
    fields, _ = TABLES[table]
    vs = versions(spark, root, table)
    if not vs:
        return spark.createDataFrame([], SC.struct(fields))
    return _typed(spark.read.parquet(f"{_dir(root, table)}/version={vs[-1]}"), table)


def _typed(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in order; nulls and columns missing in an older version take the defaults."""
    fields, _ = TABLES[table]
    have = set(df.columns)
    df = df.select(*df.columns, *[F.lit(None).cast(t).alias(n) for n, t in fields if n not in have])
    return SC.conform(df, fields, defaults(table))


def save(df: DataFrame, root: str, table: str, version: str | None = None) -> str:
    """Write a new version (stamped ``updated_at`` on the index) and return it."""
    version = version or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    _write(df, table, f"{_dir(root, table)}/version={version}")
    return version


def _write(df: DataFrame, table: str, path: str) -> None:
    fields, parts = TABLES[table]
    out = SC.conform(df, fields)
    if table == "player_index":
        out = (out.withColumn("updated_at", F.coalesce("updated_at", F.current_timestamp()))
               .withColumn("username_prefix", ST.username_prefix("username")))
    # A fresh folder per version: static mode, so the job's _SUCCESS marker
    # lands at its root and marks the version complete.
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(path)


# --- the whole state, one version ------------------------------------------------
@dataclass(frozen=True)
class Control:
    """The state tables as of one version."""

    version: snapshots.Version
    titles: DataFrame
    players: DataFrame
    index: DataFrame


def _root(root: str) -> str:
    return f"{root.rstrip('/')}/state/control"


def read(spark: SparkSession, root: str, at: snapshots.Version | None = None) -> Control:
    """The newest committed state (empty tables before the first commit), or the one at a version."""
    configure(spark)
    at = snapshots.head(spark, _root(root)) if at is None else at

    def table(name: str) -> DataFrame:
        fields, parts = TABLES[name]
        if name not in at.parts:
            return spark.createDataFrame([], SC.struct(fields))
        path = f"{_root(root)}/{at.parts[name]}"
        if not any(st.isDirectory() or st.getPath().getName().endswith(".parquet") for st in _listed(spark, path)):
            return spark.createDataFrame([], SC.struct(fields))  # an empty table partitioned on write has no file
        return _typed(spark.read.parquet(path), name)

    return Control(at, table("title_state"), table("player_state"), table("player_index"))


def _listed(spark: SparkSession, path: str) -> list:
    fs, p = raw._fs(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def commit(spark: SparkSession, root: str, seen: Control, titles: DataFrame | None = None, players: DataFrame | None = None,
           index: DataFrame | None = None) -> Control:
    """Save the given tables as the version after ``seen`` (the others stay as
    they are) and read the state back. ``StaleVersion`` if another run saved
    since ``seen`` was read; its version then stands untouched."""
    configure(spark)
    name = snapshots.folder()
    parts = dict(seen.version.parts)
    for table, df in (("title_state", titles), ("player_state", players), ("player_index", index)):
        if df is not None:
            parts[table] = f"{name}/{table}"
            _write(df, table, f"{_root(root)}/{parts[table]}")
    try:
        done = snapshots.commit(spark, _root(root), seen.version, parts)
    except snapshots.StaleVersion:
        raw.delete(spark, f"{_root(root)}/{name}")
        raise
    snapshots.prune(spark, _root(root), done)
    return read(spark, root, done)
