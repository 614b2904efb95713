"""Text of games is made behind the shuffles and sorts of the landing zone and of silver, of plain rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gamelake.plans import q_silver_gold as SG
from gamelake.sources import fixtures, raw


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Repeated lineitems and orders, nulls in every column that names or dates a game."""
    at = str(tmp_path_factory.mktemp("plain"))
    day = lambda m: dt.datetime(1995, m, 3)
    lines = [(o, p, s, n, float(10 * s), 100.0 * p, 0.05 * s, 0.04, "RAN"[s % 3], "OF"[s % 2], day(4))
             for o in (1, 2, 3, 4, None) for p in (5, 24, 50) for s, n in ((1, 1), (4, 6), (7, None))]
    for name, rows, schema in (
            ("orders", [(1, 5, day(3)), (2, 23, day(11)), (2, 23, day(11)), (3, None, day(3)), (4, 7, None)],
             "o_orderkey long, o_custkey long, o_orderdate timestamp"),
            ("part", [(5, "A B"), (24, "C"), (50, None)], "p_partkey long, p_type string"),
            ("lineitem", lines + lines[:7], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.fixture
def plan(spark):
    """Lines of a whole plan, from the top."""
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString().split("\n")
    spark.conf.set(name, before)


def same(a, b) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) and a.count() > 0


def test_documents_are_collected_from_sorted_plain_rows(spark, tables, plan):
    docs = fixtures.feed_documents(spark, tables)  # sets the session's own settings
    with raw.one_by_one(spark):
        docs = docs.select("*")
        assert all(spark.conf.get(name) == value for name, value in raw.ONE_BY_ONE.items())
        lines = plan(docs)
        one_by_one = sorted(map(str, docs.select(F.to_json(F.struct("*"))).collect()))
    at = next(i for i, x in enumerate(lines) if "REPARTITION_BY_NUM" in x)
    assert not any("ObjectHashAggregate" in x for x in lines) and sum("SortAggregate" in x for x in lines) == 2
    assert sum("Sort [ym" in x for x in lines[:at]) == 1  # the second step of the aggregate does not sort documents again
    made = [x for x in lines if "games.example" in x]
    assert made and all("SortAggregate" in x for x in made)
    assert not any(f" {c}#" in x or f"AS {c}#" in x for x in lines[at:] for c in ("bid", "side", "gid", "player"))
    assert all(spark.conf.get(name) != value for name, value in raw.ONE_BY_ONE.items())
    docs = fixtures.feed_documents(spark, tables)
    assert "ObjectHashAggregate" in "".join(plan(docs))
    assert one_by_one == sorted(map(str, docs.select(F.to_json(F.struct("*"))).collect())) and one_by_one


def test_games_are_dealt_plain(spark, tables, plan):
    lines = plan(fixtures.games_by_game(spark, tables))
    at = next(i for i, x in enumerate(lines) if "REPARTITION_BY_COL" in x)
    assert any("games.example" in x for x in lines[:at]) and not any("games.example" in x for x in lines[at:])
    assert not any("l_extendedprice" in x or "l_shipdate" in x for x in lines[:at])
    games = fixtures.view(spark, tables, "fx_games").filter("game_uuid is not null")
    assert fixtures.games_by_game(spark, tables).schema == games.schema and same(fixtures.games_by_game(spark, tables), games)
    assert "games.example" not in "\n".join(plan(SG.stg_games_by_game(spark, tables))).split("REPARTITION_BY_COL")[1]
