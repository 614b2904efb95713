"""Rows cross one shuffle, in their plain form, on their way into the landing zone and into silver."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gamelake.operators import silver
from gamelake.plans import contract
from gamelake.plans import q_silver_gold as SG
from gamelake.sources import fixtures, raw


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders without a date or a customer, repeated lineitems, players against themselves."""
    at = str(tmp_path_factory.mktemp("tables"))
    day = lambda m: dt.datetime(1995, m, 3)
    orders = [(1, 5, day(3)), (2, 24, day(3)), (3, 23, day(11)), (4, 7, None), (5, None, day(3))]
    parts = [(k, f"TYPE {k}") for k in (5, 10, 24, 50, 77)]
    lines = [(o, p, s, n, float(10 * s), 100.0 * p, 0.05 * (n % 3), 0.0 if n == 6 else 0.04, "RAN"[s % 3], "OF"[n % 2], day(4))
             for o in (1, 2, 3, 4, 5) for p in (5, 10, 24, 50, 77) for s, n in ((1, 1), (2, 1), (4, 6), (7, 7))]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp"), ("part", parts, "p_partkey long, p_type string"),
            ("lineitem", lines + lines[:9], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_hold_the_feed_rows_and_cross_one_shuffle(spark, tables, tmp_path):
    docs = fixtures.feed_documents(spark, tables)
    assert "Window" not in plan(docs) and plan(docs).count("REPARTITION_BY_NUM") == 1
    got = docs.select("year", "month", "feed", "username", "game_count", F.posexplode("games").alias("pos", "g")).select(
        "year", "month", "feed", "username", "game_count", (F.col("pos") + 1).alias("pos"), "g.uuid", "g.url", "g.end_time", "g.eco", "g.pgn",
        F.col("g.white.rating").alias("wr"), F.col("g.black.username").alias("bu"), F.col("g.black.result").alias("br"))
    # Rows without a file name are numbered together in fx_feed; a document counts its own.
    own = Window.partitionBy("raw_key", "year", "month").orderBy("pos")
    fx = fixtures.view(spark, tables, "fx_feed").withColumn("pos", F.row_number().over(own))
    doc = fx.groupBy("raw_key", "year", "month").agg(
        F.when(F.count("source_username") == F.count(F.lit(1)), F.max("source_username")).alias("username"), F.count(F.lit(1)).alias("game_count"))
    same = [F.col(f"fx.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ("raw_key", "year", "month")]
    want = fx.alias("fx").join(doc.alias("d"), same).select(
        "fx.year", "fx.month", F.regexp_extract("fx.raw_key", r"username=([^/]+)\.json$", 1).alias("feed"), "username", "game_count", "pos",
        "uuid", "url", "end_time", "eco", "pgn", F.col("white_rating").alias("wr"), F.col("black_username").alias("bu"), F.col("black_result").alias("br"))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    raw.write_feed(docs.filter("feed is not null and year is not null"), str(tmp_path / "zone"), dealt=True)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    names = [n for n in raw.file_names(spark, str(tmp_path / "zone")) if "/feed=" in n and not n.endswith(".crc")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert raw.read_feed(spark, str(tmp_path / "zone")).agg(F.sum(F.size("games"))).first()[0] == \
        docs.filter("feed is not null and year is not null").agg(F.sum("game_count")).first()[0]


def test_games_are_dealt_once_for_both_dedups(spark, tables):
    facts, games = SG.silver_facts(spark, tables), SG.silver_games(spark, tables)
    for df in (facts, games):
        assert plan(df).count("hashpartitioning(game_uuid") == plan(df).count("REPARTITION_BY_COL") == 1
    plain = silver.silver_facts(SG.stg_facts(spark, tables))
    assert sorted(map(repr, facts.collect())) == sorted(map(repr, plain.collect())) and facts.count() > 0
    plain = silver.silver_games(SG.stg_games(spark, tables))
    assert sorted(map(repr, games.collect())) == sorted(map(repr, plain.collect())) and games.count() > 0


def test_month_counts_read_the_games_once(spark, tables):
    counts = contract.load_all()["month_filter"].build(spark, tables)
    assert plan(counts).count("REPARTITION_BY_COL") == 1
    assert {r["mode"]: r["n"] for r in counts.collect()}["none"] == SG.silver_games(spark, tables).count()
