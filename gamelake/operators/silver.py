"""Bronze -> silver: typed staging, first-wins dedup, cleaned projections.

Dedup is ``row_number() over (partition by key order by ...) = 1``. Spark
plans it with a partial ``WindowGroupLimit`` before the shuffle: every map
task keeps only its best row per key, so a hot key (one game seen in
thousands of feeds) arrives at its reducer as one row per map task, never as
the whole group.

Where games are few rows each, ``by_game`` ahead of the staging saves that
sort: the plain rows are shuffled once, and staged, exploded into player rows
and ranked where they then lie. ``by_month`` behind the staging does so for
rows that are written by month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.functions import exprs as X


# --- C1 / C2 / C3 -----------------------------------------------------------
def _stage(bronze: DataFrame, fields) -> DataFrame:
    fill = {
        "year": F.col("year").cast("string"),
        "month": F.lpad(F.col("month").cast("string"), 2, "0"),
        "month_key": X.month_key("year", "month"),
    }
    if "bucket" not in bronze.columns:
        fill["bucket"] = F.lit(None)
    return SC.conform(bronze, fields, fill)


def stage_games(bronze_games: DataFrame) -> DataFrame:
    return _stage(bronze_games, SC.STG_GAMES)


def stage_facts(bronze_facts: DataFrame) -> DataFrame:
    return _stage(bronze_facts, SC.STG_FACTS)


def stage_roster(bronze_roster: DataFrame) -> DataFrame:
    return SC.conform(bronze_roster, SC.STG_ROSTER)


# --- generic first-wins dedup -------------------------------------------------
def sort_cols(*specs: tuple[str | Column, str]) -> list[Column]:
    """``(column, 'asc'|'desc')`` -> sort columns with nulls last either way."""
    return [X.col(c).desc_nulls_last() if d == "desc" else X.col(c).asc_nulls_last() for c, d in specs]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_late(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``first_per_key`` for rows that are cheap to read again (files): the same rows.

    One aggregation of the keys names those of several rows, usually few.
    Rows of other keys skip the shuffle with their payload; the named ones
    are ranked. Spark broadcasts a short list of keys and splits hot ones."""
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys)
    single = df.join(several, list(keys), "left_anti")
    return single.unionByName(first_per_key(df.join(several, list(keys), "left_semi"), keys, order)).select(*df.columns)


def by_game(games: DataFrame) -> DataFrame:
    """Games with all rows of a ``game_uuid`` in one partition, which serves the
    dedup of games and that of their player rows. Rows without one, which no
    dedup keeps, are left out."""
    return games.filter(F.col("game_uuid").isNotNull()).repartition("game_uuid")


#: Column of ``by_month``: the slice of a month in which a game lies.
MONTH_SLICE = "_slice"


def by_month(stg: DataFrame) -> DataFrame:
    """Staged rows (games or player rows) dealt by month, a month in slices by ``game_uuid``: one shuffle that
    serves both the dedup, which ranks where the rows lie, and a sink on (year, month), for which they then lie in
    order. A month has a slice for every 16 shuffle partitions, so a hot month is spread over tasks."""
    slices = max(1, int(stg.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    # As the sink would name the directories, but never null: then it need not sort the rows again.
    never_null = {c: F.coalesce(F.nullif(c, F.lit("")), F.lit(SC.NO_VALUE)) for c in ("year", "month")}
    return stg.withColumns(never_null | {MONTH_SLICE: F.pmod(F.xxhash64("game_uuid"), F.lit(slices))}).repartition("year", "month", MONTH_SLICE)


def _in_months(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``first_late`` of rows dealt by ``by_month``: the same rows. As there, a key without a year or a month
    equals no other, so its rows all stay."""
    lie = ["year", "month", MONTH_SLICE]
    at = Window.partitionBy(*lie, *[k for k in keys if k not in lie]).orderBy(*order)
    undated = (F.col("year") == SC.NO_VALUE) | (F.col("month") == SC.NO_VALUE)
    return df.withColumn("_rn", F.row_number().over(at)).filter((F.col("_rn") == 1) | undated).drop("_rn", MONTH_SLICE)


# --- C7 / C8 ----------------------------------------------------------------
# The game first: the keys are sorted in this order, and years and months tell few rows apart.
GAME_KEYS = ("game_uuid", "year", "month")
GAME_ORDER = (("source_key_count", "desc"), ("source_player_count", "desc"), ("game_url", "asc"))


def _first(stg: DataFrame, late: bool):
    if MONTH_SLICE in stg.columns:
        return _in_months
    return first_late if late else first_per_key


def default_game_tie_break(columns: Sequence[str]) -> list[str]:
    """After the defined order keys, every other column ascending: the pick
    among exact ties is then fixed, whatever the input order."""
    taken = set(GAME_KEYS) | {c for c, _ in GAME_ORDER} | {"month_key", "bucket", MONTH_SLICE}
    return [c for c in columns if c not in taken]


def dedup_games(stg: DataFrame, tie_break: Sequence[str] | None = None, late: bool = False) -> DataFrame:
    tie = default_game_tie_break(stg.columns) if tie_break is None else list(tie_break)
    order = sort_cols(*GAME_ORDER, *[(c, "asc") for c in tie])
    return _first(stg, late)(stg.filter(F.col("game_uuid").isNotNull()), list(GAME_KEYS), order)


def silver_games(stg: DataFrame, month: str | None = None, months: Sequence[str] | None = None,
                 tie_break: Sequence[str] | None = None, late: bool = False) -> DataFrame:
    src = stg.filter(X.month_filter(month, months))
    g = dedup_games(src, tie_break, late)
    return g.select(
        "month_key", "year", "month", "game_uuid", "game_url",
        F.col("game_date").cast("date").alias("game_date"),
        "end_time_utc",
        F.lower("time_class").alias("time_class"),
        "time_control",
        F.coalesce("rated", F.lit(False)).alias("rated"),
        "rules", "opening_url", "opening_name", "initial_setup", "fen",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("has_pgn", "has_tcn", "has_accuracies")],
        "white_username", "white_title", "white_rating", "white_result", "white_score", "white_accuracy",
        "black_username", "black_title", "black_rating", "black_result", "black_score", "black_accuracy",
        "winner_color", "source_key_count", "source_player_count", "source_player_usernames",
        (F.col("white_title").isNotNull() & F.col("black_title").isNotNull()).alias("is_titled_matchup"),
    )


# --- C9 / C10 / C11 ---------------------------------------------------------
FACT_KEYS = ("game_uuid", "year", "month", "username")


def fact_order(tie_break: Sequence[str] = ()) -> list[Column]:
    return sort_cols(
        (F.when(F.col("title").isNotNull(), 0).otherwise(1), "asc"),
        (F.when(F.col("opponent_title").isNotNull(), 0).otherwise(1), "asc"),
        ("color", "asc"),
        *[(c, "asc") for c in tie_break],
    )


def dedup_facts(stg: DataFrame, tie_break: Sequence[str] | None = None, late: bool = False) -> DataFrame:
    if tie_break is None:
        taken = set(FACT_KEYS) | {"title", "opponent_title", "color", "month_key", "bucket", MONTH_SLICE}
        tie_break = [c for c in stg.columns if c not in taken]
    src = stg.filter(F.col("game_uuid").isNotNull() & F.col("username").isNotNull())
    return _first(stg, late)(src, list(FACT_KEYS), fact_order(tie_break))


def score_band(score: str | Column = "score") -> Column:
    s = X.col(score)
    return (F.when(s == 1.0, "win").when(s == 0.5, "draw").when(s == 0.0, "loss").otherwise("unknown"))


def silver_facts(stg: DataFrame, month: str | None = None, months: Sequence[str] | None = None,
                 tie_break: Sequence[str] | None = None, late: bool = False) -> DataFrame:
    # Titled rows come first in the order, so rows without a title decide nothing among the rows that stay.
    src = stg.filter(X.month_filter(month, months) & F.col("title").isNotNull())
    f = dedup_facts(src, tie_break, late)
    return f.filter(F.coalesce("is_titled_player", F.lit(False)) & F.col("title").isNotNull()).select(
        "month_key", "year", "month", "game_uuid", "game_url",
        F.col("game_date").cast("date").alias("game_date"),
        "end_time_utc", F.lower("time_class").alias("time_class"), "time_control",
        F.coalesce("rated", F.lit(False)).alias("rated"),
        "rules", "opening_url", "opening_name", "winner_color",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("has_pgn", "has_tcn", "has_accuracies")],
        "username", "title", "opponent_username", "opponent_title", "color", "rating", "opponent_rating",
        "rating_diff", "result", "score", "accuracy", "opponent_accuracy",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_titled_player", "is_titled_opponent")],
        score_band("score").alias("score_band"),
    )


# --- C12 / C13 --------------------------------------------------------------
#: Positions of a roster ranked together; a roster has as many slices as its positions span.
SLICE = 10_000


def silver_roster(stg: DataFrame, snapshot_date: str | None = None, slice_size: int = SLICE) -> DataFrame:
    """Best position per (date, title, username), then a gap-free rank.

    The rank is a prefix sum: players are ranked within slices of
    ``slice_size`` positions, and each slice is offset by the number of
    players in the slices before it. A title of any size is so spread over
    many tasks; only slice counts of a title meet in one. Players without a
    position share the last slice, in name order, split by the name's first
    letters.
    """
    src = stg.filter(X.snapshot_filter(snapshot_date))
    order = sort_cols(("snapshot_position", "asc"), ("username", "asc"), ("snapshot_player_count", "asc"))
    best = first_per_key(src, ["snapshot_date", "title", "username"], order)
    part = F.struct(F.floor(F.col("snapshot_position") / slice_size).alias("n"),
                    F.when(F.col("snapshot_position").isNull(), F.substring("username", 1, 2)).alias("name"))
    best = best.withColumn("_slice", part)
    group = ["snapshot_date", "title"]
    sliced = [F.col("_slice.n").asc_nulls_last(), F.col("_slice.name").asc_nulls_last()]
    before = Window.partitionBy(*group).orderBy(*sliced).rowsBetween(Window.unboundedPreceding, -1)
    offsets = best.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(c).alias(f"_{c}") for c in group], F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_slice").orderBy(F.col("snapshot_position").asc_nulls_last(), F.col("username").asc_nulls_last())
    ranked = best.withColumn("_rank", F.row_number().over(inside))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group] + [F.col("_slice").eqNullSafe(F.col("_s"))]
    return ranked.join(offsets, same, "left").select(
        "snapshot_date", "title", "username", "snapshot_player_count", "snapshot_position",
        (F.col("_rank") + F.col("_before")).cast("bigint").alias("snapshot_rank"))
