"""What crosses a shuffle or lands on disk in the bronze build and the re-layout stays small."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gamelake.operators import bronze, layout
from gamelake.plans import q_bronze
from gamelake.sources import fixtures, raw


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sizes"))
    day = dt.datetime(1995, 3, 3)
    for name, rows, schema in (
            ("orders", [(1, 5, day), (2, 24, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
            ("part", [(5, "A B"), (10, "C")], "p_partkey long, p_type string"),
            ("lineitem", [(o, p, s, n, 10.0, 100.0, 0.05, 0.04, "RAN"[s % 3], "OF"[n % 2], day) for o in (1, 2) for p in (5, 10) for s, n in ((1, 1), (2, 2))],
             "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_games_are_not_shuffled_to_find_their_titles(spark, tables):
    games, _ = q_bronze.bronze_tables(spark, tables)
    assert "SortMergeJoin" not in plan(games) and "hashpartitioning(white" not in plan(games)
    text = fixtures.FX_TITLES.replace("{fx_games}", "{g}")
    want = spark.sql(text.replace(" g where", " where"), g=fixtures.view(spark, tables, "fx_games"))
    got = fixtures.titles(spark, tables).select("title", "username")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0


@pytest.mark.parametrize("first, second, want", [("a", "b", "a"), ("", "b", "b"), (None, "b", "b"), ("", None, ""), (None, "", None), (None, None, None)])
def test_first_value_of_a_game_travels_once(spark, first, second, want):
    side = F.struct(F.lit("x").alias("username"), F.lit("1").alias("rating"), F.lit("win").alias("result"))
    none = [F.lit(None).cast("string").alias(c) for c in ("time_class", "time_control", "rules", "pgn", "tcn", "fen", "initial_setup", "accuracies")]
    occ = spark.createDataFrame([("k1", 0, first), ("k2", 0, second)], "raw_key string, pos int, eco string").select(
        "*", F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("u").alias("source_username"), F.lit("g").alias("uuid"), F.lit("l").alias("url"),
        F.lit("1").alias("end_time"), F.lit(True).alias("rated"), side.alias("white"), side.alias("black"), *none)
    merged = bronze.merge_games(occ)
    assert "first_eco, CASE WHEN" in plan(merged)  # carried beside the fill only where it is empty
    assert [r.eco for r in merged.collect()] == [want]


def test_moved_documents_are_gzipped_and_whole(spark, tmp_path):
    value = '{"username":"ann","games":[{"uuid":"\\u00e9"},  {"uuid":"b"}]}'
    keys = spark.createDataFrame([("raw/player_games/ann/2024/01.json", value), ("raw/player_games/bob/2024/01.json", value[:-9])], "key string, value string")
    row = layout.relayout_run(keys.select("key"), lambda todo: keys.join(todo.select("key"), "key", "left_semi"), f"{tmp_path}/new", f"{tmp_path}/moves").first()
    assert (row.planned, row.moved, row.failed) == (2, 1, 1)
    names = [n for n in raw.file_names(spark, f"{tmp_path}/new") if "/feed=" in n and not n.endswith(".crc")]
    assert len(names) == 1 and names[0].endswith(".gz")
    assert [r.value for r in spark.read.text(names, wholetext=True).collect()] == [value + "\n"]
    assert [len(r.games) for r in raw.read_feed(spark, f"{tmp_path}/new").collect()] == [2]


def test_a_task_makes_its_documents_one_by_one(spark, tables, tmp_path):
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    docs = fixtures.feed_documents(spark, tables)
    before, rows = spark.conf.get(name), lambda: sorted(str(r.asDict()) for r in docs.select(F.to_json(F.struct("*")).alias("v")).collect())
    plain = rows()
    with raw.one_by_one(spark):
        assert spark.conf.get(name) == "1"
        docs = fixtures.feed_documents(spark, tables)
        spark.conf.set(name, "1")  # configure() sets the session's own
        assert rows() == plain and plain
    assert spark.conf.get(name) == before
    raw.write_feed(docs, f"{tmp_path}/zone", dealt=True)
    assert spark.conf.get(name) == before and raw.read_feed(spark, f"{tmp_path}/zone").count() == len(plain)
