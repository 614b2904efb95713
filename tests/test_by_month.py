"""The lake's silver rows cross one shuffle, which serves the dedup and the sink; pair games none."""

import uuid

import pytest
from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.operators import gold, silver
from gamelake.plans import pipeline
from gamelake.session import scratch_path
from gamelake.sources import lake


@pytest.fixture
def partitions(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "64")
    yield
    spark.conf.set(name, before)


def bronze(spark, fields):
    """Games in one to many rows, some months null, exact ties on the order columns, a hot key, null keys."""
    i = F.col("id")
    made = {
        "year": F.when(i % 41 > 0, F.when(i % 3 == 0, "2023").otherwise("2024")), "month": F.lpad((i % 4).cast("string"), 2, "0"), "bucket": F.lit("00"),
        "game_uuid": F.when(i < 300, "hot").when(i % 53 > 0, F.concat(F.lit("g"), (i % 170).cast("string"))),
        "game_url": F.when(i % 5 > 0, F.concat(F.lit("u"), (i % 3).cast("string"))), "game_date": F.lit("2024-01-01"),
        "source_key_count": F.when(i % 7 > 0, (i % 2).cast("int")), "source_player_count": F.lit(1), "opening_name": (i % 11).cast("string"),
        "username": F.when(i % 29 > 0, F.concat(F.lit("p"), (i % 4).cast("string"))), "title": F.when(i % 3 > 0, "GM"), "is_titled_player": i % 3 > 0,
        "opponent_title": F.when(i % 2 > 0, "IM"), "color": F.when(i % 2 > 0, "white").otherwise("black"), "score": (i % 3) / 2,
        "white_username": F.lit("a"), "black_username": F.lit("b"), "white_title": F.lit("GM"), "black_title": F.lit("IM")}
    return SC.conform(spark.range(900), fields, made)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def test_months_dealt_once_give_the_same_rows(spark, partitions):
    for stage, dedup, fields in ((silver.stage_games, silver.silver_games, SC.BUCKET_PARTS + SC.GAMES_CORE),
                                 (silver.stage_facts, silver.silver_facts, SC.BUCKET_PARTS + SC.PLAYER_FACTS)):
        stg = stage(bronze(spark, fields))
        dealt, plain = dedup(silver.by_month(stg)), dedup(stg, late=True)
        assert plan(dealt).count("Exchange ") == plan(dealt).count("REPARTITION_BY_COL") == 1
        assert dealt.columns == plain.columns and plain.filter("year is null").count() > 0
        back = dealt.withColumns({c: F.nullif(c, F.lit(SC.NO_VALUE)) for c in ("year", "month")})  # as a sink would read it
        assert rows(back) == rows(plain) and 100 < plain.count() < 900
        # Rows without a year or a month are never taken for repeats.
        assert plain.filter("year is null").count() > plain.filter("year is null").select("game_uuid", "month").distinct().count()


def test_the_lake_shuffles_silver_rows_once_and_keeps_months_together(spark, partitions):
    root = scratch_path(spark, "by-month", uuid.uuid4().hex[:8])
    games = bronze(spark, SC.BUCKET_PARTS + SC.GAMES_CORE)
    facts = bronze(spark, SC.BUCKET_PARTS + SC.PLAYER_FACTS)
    lake.write_bronze_games(games, root, replace_all=True)
    lake.write_bronze_facts(facts, root, replace_all=True)
    pipeline.build_silver(spark, root, None)
    pipeline.build_gold(spark, root, None)
    for table, want in ((lake.SILVER_GAMES, silver.silver_games(silver.stage_games(games), late=True)), (lake.SILVER_FACTS, silver.silver_facts(silver.stage_facts(facts), late=True))):
        got = lake.read(spark, root, table)
        assert rows(got.select(sorted(want.columns))) == rows(want.select(sorted(want.columns)))
        # A month lies in at most as many files as it has slices.
        files = got.select("year", "month", F.col("_metadata.file_path").alias("file")).distinct().groupBy("year", "month").count()
        assert files.agg(F.max("count")).first()[0] <= 4
    pairs = gold.h2h_games(silver.silver_games(silver.stage_games(games), late=True))
    got = lake.read(spark, root, "gold/head_to_head_games")
    assert rows(got.select(sorted(pairs.columns))) == rows(pairs.select(sorted(pairs.columns))) and pairs.count() > 0
    before = rows(got)
    pipeline.build_silver(spark, root, ["2024-01"])
    pipeline.build_gold(spark, root, ["2024-01"])
    assert rows(lake.read(spark, root, "gold/head_to_head_games")) == before
