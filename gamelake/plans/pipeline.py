"""Layered build: raw feed -> bronze -> silver -> gold, for a set of months.

One job per table covers all selected months (not one job per month). Each
layer is read back from its written partitions, which cuts the lineage at
every layer: a lost executor re-runs from the last written table, not from
the raw JSON.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.functions import exprs as X
from gamelake.operators import bronze, gold, silver
from gamelake.sources import lake, raw, snapshots, state_store


def month_counts(games: DataFrame, facts: DataFrame) -> DataFrame:
    """B21: unique games and player rows per month in one aggregation."""
    g = games.select("year", "month", F.lit(1).alias("g"), F.lit(0).alias("f"))
    f = facts.select("year", "month", F.lit(0).alias("g"), F.lit(1).alias("f"))
    return (g.unionByName(f).groupBy("year", "month")
            .agg(F.sum("g").cast("bigint").alias("unique_games"), F.sum("f").cast("bigint").alias("player_rows"))
            .filter(F.col("unique_games") > 0))


@dataclass
class RunReport:
    months: list[str]
    counts: dict[str, int] = field(default_factory=dict)


def bronze_games_of(feed: DataFrame, roster_members: DataFrame | None, buckets: int) -> DataFrame:
    """Feed documents -> bronze games with titles and buckets."""
    merged = bronze.merge_games(bronze.explode_feed(feed))
    merged = merged.withColumn("white_username", F.col("white.username")).withColumn(
        "black_username", F.col("black.username"))
    if roster_members is not None:
        merged = bronze.title_enrich(merged, bronze.title_lookup(roster_members))
    return bronze.with_game_bucket(bronze.games_core_rows(merged.drop("white_username", "black_username")), buckets)


def build_bronze_months(spark: SparkSession, raw_root: str, lake_root: str, months: Sequence[str] | None,
                        roster_members: DataFrame | None, buckets: int = X.DEFAULT_BUCKETS,
                        files_per_bucket: int | None = None) -> dict[str, int]:
    """Raw feed -> bronze games (written), then player rows from the written
    games (the merge runs once, and facts restart from a table, not the JSON).
    Which selected months have documents is read off the directories; one
    without any keeps its bronze."""
    def facts_of(games: DataFrame) -> DataFrame:
        facts = bronze.with_fact_bucket(bronze.player_rows(games.drop("bucket")), buckets)
        return SC.conform(facts, SC.MONTH_PARTS + SC.PLAYER_FACTS + [("bucket", SC.S)])

    if not months:
        games = bronze_games_of(raw.read_feed(spark, raw_root, opened=False), roster_members, buckets)
        lake.write_bronze_games(games, lake_root, files_per_bucket, replace_all=True)
        written = lake.read_bronze_games(spark, lake_root)
        lake.write_bronze_facts(facts_of(written), lake_root, files_per_bucket, replace_all=True)
        # Row counts of the written files (Parquet footers).
        return {"unique_games": written.count(), "player_rows": lake.read_bronze_facts(spark, lake_root).count()}
    have = raw.month_dirs(spark, raw_root)
    present = sorted(set(months) & set(have))
    if not present:
        return {"unique_games": 0, "player_rows": 0}
    games = bronze_games_of(raw.read_feed(spark, raw_root, present, opened=False), roster_members, buckets)
    n_games = lake.write_selected(games, lake_root, lake.BRONZE_GAMES, lake.BRONZE_PARTS, present, files_per_bucket, "game_uuid")
    facts = facts_of(lake.read_bronze_games(spark, lake_root, present))
    n_facts = lake.write_selected(facts, lake_root, lake.BRONZE_FACTS, lake.BRONZE_PARTS, present, files_per_bucket, "username")
    return {"unique_games": sum(n_games.values()), "player_rows": sum(n_facts.values())}


def write_months(df: DataFrame, lake_root: str, table: str, months: Sequence[str] | None, sort: str | None = None, dealt: bool = False) -> None:
    """Write a month table; selected months that gave no rows are cleared afterwards."""
    if months:
        lake.write_selected(df, lake_root, table, ["year", "month"], sorted(set(months)), sort=sort, dealt=dealt)
    else:
        lake.write_month_table(df, lake_root, table, replace_all=True, sort=sort, dealt=dealt)


def build_silver(spark: SparkSession, lake_root: str, months: Sequence[str] | None,
                 roster: DataFrame | None = None) -> None:
    g = silver.silver_games(silver.by_month(silver.stage_games(lake.read_bronze_games(spark, lake_root, months))))
    f = silver.silver_facts(silver.by_month(silver.stage_facts(lake.read_bronze_facts(spark, lake_root, months))))
    write_months(g, lake_root, lake.SILVER_GAMES, months, dealt=True)
    write_months(f, lake_root, lake.SILVER_FACTS, months, dealt=True)
    if roster is not None:
        # A8: bronze roster by (snapshot_date, title), then silver from the written table.
        lake.write_roster(roster.select("snapshot_date", "title", "username", "snapshot_player_count",
                                        "snapshot_position"), lake_root)
        bronze_roster = lake.read(spark, lake_root, lake.BRONZE_ROSTER)
        lake.write_snapshot_table(silver.silver_roster(silver.stage_roster(bronze_roster)), lake_root,
                                  lake.SILVER_ROSTER)


def build_gold(spark: SparkSession, lake_root: str, months: Sequence[str] | None) -> None:
    none = {t: spark.createDataFrame([], s) for t, s in lake.TABLE_SCHEMAS.items()}
    games_schema = silver.silver_games(silver.stage_games(none[lake.BRONZE_GAMES])).schema
    facts_schema = silver.silver_facts(silver.stage_facts(none[lake.BRONZE_FACTS])).schema
    games = lake.read(spark, lake_root, lake.SILVER_GAMES, months, games_schema)
    facts = lake.read(spark, lake_root, lake.SILVER_FACTS, months, facts_schema)
    marts = {
        "title_month_activity": gold.title_month_activity(facts),
        "title_month_rating_volatility": gold.title_month_volatility(facts),
        "title_month_color_performance": gold.title_month_color(facts),
    }
    for name, df in marts.items():
        write_months(df, lake_root, f"gold/{name}", months)
    pairs = gold.h2h_games(games)
    # Read from files of a month each, in which order they are written again.
    write_months(pairs, lake_root, "gold/head_to_head_games", months, dealt=True)
    monthly = gold.h2h_monthly(lake.read(spark, lake_root, "gold/head_to_head_games", months, pairs.schema))
    build_pair_marts(spark, lake_root, monthly, months)


PAIRS_MONTHLY = "gold/head_to_head_monthly"


def build_pair_marts(spark: SparkSession, lake_root: str, monthly: DataFrame, months: Sequence[str] | None) -> list[str] | None:
    """D10, D11: the monthly mart of the months, then the all-time mart from every month's partials.

    A run over some months rebuilds only the all-time buckets that hold a
    pair of those months, before or after the run; the others keep their
    files. Returns the rebuilt buckets (None: all of them)."""
    schema = monthly.schema

    def buckets() -> set[str]:
        rows = lake.read(spark, lake_root, PAIRS_MONTHLY, months, schema).select(lake.SUMMARY_PART).distinct().collect()
        return {r[lake.SUMMARY_PART] for r in rows}  # at most 256

    partial = bool(months) and snapshots.head(spark, lake.path(lake_root, lake.GOLD_SUMMARY)).number > 0
    touched = buckets() if partial else set()
    # In bucket order: a read of some buckets skips the row groups of the others.
    write_months(monthly, lake_root, PAIRS_MONTHLY, months, sort=lake.SUMMARY_PART)
    every_month = lake.read(spark, lake_root, PAIRS_MONTHLY, schema=schema)
    if not partial:
        lake.write_full(gold.h2h_summary(every_month), lake_root, lake.GOLD_SUMMARY)
        return None
    touched = sorted(touched | buckets())
    if touched:
        summary = gold.h2h_summary(every_month.filter(F.col(lake.SUMMARY_PART).isin(touched)))
        lake.write_parts(summary, lake_root, lake.GOLD_SUMMARY, lake.SUMMARY_PART, touched)
    return touched


def run(spark: SparkSession, raw_root: str, lake_root: str, months: Sequence[str] | None = None,
        roster_members: DataFrame | None = None, roster: DataFrame | None = None,
        buckets: int = X.DEFAULT_BUCKETS, state_root: str | None = None) -> RunReport:
    """G4: bronze for the months, silver (and roster when given), gold, then
    the all-time mart once.

    Titles come from ``roster_members`` (title, username), or from the control
    state saved under ``state_root``: all its players, removed ones too."""
    if roster_members is None and state_root is not None:
        roster_members = state_store.read(spark, state_root).players.select("title", "username")
    counts = build_bronze_months(spark, raw_root, lake_root, months, roster_members, buckets)
    build_silver(spark, lake_root, months, roster)
    build_gold(spark, lake_root, months)
    return RunReport(list(months or []), counts)
