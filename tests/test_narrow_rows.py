"""Rows on their way into the landing zone and through the merge carry what is read of them, no more."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gamelake.operators import bronze
from gamelake.plans import q_bronze
from gamelake.sources import fixtures


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Lineitems that only price, date or quantity tells apart, in falling order, beside others; lines without a number or a supplier."""
    at = str(tmp_path_factory.mktemp("narrow"))
    day = lambda m: dt.datetime(1995, m, 3)
    lines = [(1, 5, 2, 1, q, price, discount, 0.04, "R", "O", day(m))
             for q, price, discount, m in ((2.0, 200.0, 0.0, 4), (2.0, 100.0, 0.05, 4), (2.0, 100.0, 0.0, 3), (1.0, 100.0, 0.08, 3))]
    lines += [(o, 5, s, n, 3.0, 400.0 - 100 * o, 0.05 * (o - 1), 0.04, "A", "F", day(4)) for o in (1, 2) for s, n in ((2, None), (None, 1), (3, 3))]
    for name, rows, schema in (
            ("orders", [(1, 5, day(3)), (2, 5, day(3))], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
            ("part", [(5, "A B")], "p_partkey long, p_type string"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_tie_breaks_are_carried_where_there_is_a_tie(spark, tables):
    sides = fixtures.feed_sides(spark, tables)
    carried = {(r.l_orderkey, r.l_suppkey, r.l_linenumber): r.l_extendedprice is not None and r.l_shipdate is not None and r.l_quantity is not None
               for r in sides.collect()}
    assert carried == {(1, 2, 1): True, (1, 2, None): True, (2, 2, None): True, (1, None, 1): True, (2, None, 1): True, (1, 3, 3): False, (2, 3, 3): False}
    got = fixtures.feed_documents(spark, tables).select("year", "month", "feed", F.posexplode("games").alias("pos", "g")).select(
        "year", "month", "feed", (F.col("pos") + 1).alias("pos"), "g.uuid", "g.url", "g.time_class", "g.rated", "g.eco", F.col("g.white.rating").alias("r"))
    want = fixtures.view(spark, tables, "fx_feed").select(
        "year", "month", F.regexp_extract("raw_key", r"username=([^/]+)\.json$", 1).alias("feed"), "pos", "uuid", "url", "time_class", "rated", "eco",
        F.col("white_rating").alias("r"))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect()))) and got.count() > 10


def test_merge_shuffles_what_a_query_reads(spark, tables):
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    try:
        merged = bronze.merge_games(bronze.explode_feed(q_bronze.feed(spark, tables)))
        for read, sides, about in ((["white", "black"], True, False), (["year", "has_pgn"], False, False), (["end_time", "eco"], False, True)):
            text = merged.select(*read)._jdf.queryExecution().executedPlan().toString()
            assert ("partial_min_by(struct(white" in text, "partial_min_by(struct(uuid" in text) == (sides, about), (read, text)
    finally:
        spark.conf.set(name, before)
