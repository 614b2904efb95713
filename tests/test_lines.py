"""Documents are written line by line and read game by game: no task holds the games of a document."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gamelake.operators import bronze
from gamelake.plans import contract, q_bronze
from gamelake.sources import fixtures, raw


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders without a date or a customer, repeated lineitems, players against themselves."""
    at = str(tmp_path_factory.mktemp("lines"))
    day = lambda m: dt.datetime(1995, m, 3)
    lines = [(o, p, s, n, float(10 * s), 100.0 * p, 0.05 * (n % 3), 0.0 if n == 6 else 0.04, "RAN"[s % 3], "OF"[n % 2], day(4))
             for o in (1, 2, 3, 4, 5) for p in (5, 10, 24, 50, 77) for s, n in ((1, 1), (2, 1), (4, 6), (7, 7))]
    for name, rows, schema in (
            ("orders", [(1, 5, day(3)), (2, 24, day(3)), (3, 23, day(11)), (4, 7, None), (5, None, day(3))], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
            ("part", [(k, f"TYPE {k}") for k in (5, 10, 24, 50, 77)], "p_partkey long, p_type string"),
            ("lineitem", lines + lines[:9], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def documents(feed) -> list[str]:
    return sorted(r.v for r in feed.drop("raw_key").select(F.to_json(F.struct("*")).alias("v")).collect())


def files(spark, root) -> list[str]:
    return [n for n in raw.file_names(spark, root) if "/feed=" in n and not n.endswith(".crc")]


def test_lines_are_the_same_documents(spark, tables, tmp_path):
    lines, whole = f"{tmp_path}/lines", f"{tmp_path}/whole"
    rows = fixtures.feed_lines(spark, tables)
    assert plan(rows).count("REPARTITION_BY_NUM") == 1 and "collect_list" not in plan(rows)
    raw.write_lines(rows, lines)
    raw.write_feed(fixtures.feed_documents(spark, tables), whole, dealt=True)
    assert documents(raw.read_feed(spark, lines)) == documents(raw.read_feed(spark, whole))
    assert len(files(spark, lines)) == len(files(spark, whole)) > 5
    assert sorted(n.split("/part-")[0].split("/lines/")[1] for n in files(spark, lines)) == \
        sorted(n.split("/part-")[0].split("/whole/")[1] for n in files(spark, whole))
    zone = fixtures.landing_zone(spark, tables)
    assert all(n.endswith(".txt.gz") for n in files(spark, zone)) and documents(raw.read_feed(spark, zone)) == documents(raw.read_feed(spark, lines))


def test_a_task_writes_many_documents_in_order(spark, tmp_path):
    """More documents a task than files may be open; games out of order; odd texts and names."""
    n = raw.OPEN_DOCUMENTS + 40
    occ = spark.range(5 * n).select(
        F.lit("2024").alias("year"), F.lit("01").alias("month"), F.concat(F.lit("p"), F.col("id") % n).alias("user"), (4 - F.floor(F.col("id") / n)).cast("int").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit('a"\n],é')).otherwise(F.col("id").cast("string")).alias("uuid"), F.col("id").cast("string").alias("url"),
        F.lit('{"white":1,"black":"x"}').alias("accuracies"), F.lit(True).alias("rated"),
        *[F.struct(F.lit(s).alias("username"), F.lit(None).cast("string").alias("rating"), F.lit("win").alias("result")).alias(s) for s in ("white", "black")],
        *[F.lit(None).cast("string").alias(c) for c in ("end_time", "time_class", "time_control", "rules", "eco", "initial_setup", "fen", "pgn", "tcn")])
    occ = occ.withColumn("user", F.when(F.col("user") != "p7", F.col("user")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        raw.write_lines(raw.packed_lines(occ, "user"), f"{tmp_path}/lines")
        raw.write_feed(raw.pack_feed(occ, "user"), f"{tmp_path}/whole", dealt=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(files(spark, f"{tmp_path}/lines")) == n
    got = documents(raw.read_feed(spark, f"{tmp_path}/lines"))
    assert got == documents(raw.read_feed(spark, f"{tmp_path}/whole")) and len(got) == n
    assert [len(json.loads(d)["games"]) for d in got] == [5] * n


def test_games_are_opened_one_at_a_time(spark, tmp_path):
    """A closed document gives the rows of an open one, whatever the layout of its file; one that is none fails the read."""
    games = [{"uuid": "a", "end_time": 12, "accuracies": {"white": 81.5, "black": "x"}, "white": {"username": "A", "rating": 2500}},
             {"uuid": "", "url": "u", "accuracies": "{\"white\": 50}", "rated": True}, None, {"uuid": "a", "pgn": "1. e4", "more": [1, {"x": 2}]}]
    place = tmp_path / "year=2024" / "month=01"
    for name, doc, indent in (("one", {"username": "A", "games": games}, None), ("two", {"username": None, "game_count": 9, "games": games[:2]}, 2),
                              ("none", {"username": "B"}, None), ("empty", {"username": "C", "games": []}, None)):
        (place / f"feed={name}").mkdir(parents=True)
        (place / f"feed={name}" / "x.json").write_text(json.dumps(doc, indent=indent))
    opened, closed = raw.read_feed(spark, f"file://{tmp_path}"), raw.read_feed(spark, f"file://{tmp_path}", opened=False)
    assert dict(closed.dtypes)["games"] == "array<string>" and closed.columns == opened.columns
    head = ("feed", "username", "game_count", "raw_key")
    assert sorted(map(repr, closed.select(*head).collect())) == sorted(map(repr, opened.select(*head).collect()))
    want = bronze.explode_feed(opened).drop("again")
    got = bronze.explode_feed(closed)
    assert got.schema == want.schema and got.count() == 6
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    merged = [bronze.merge_games(bronze.explode_feed(x)) for x in (opened, closed)]
    assert "Window" not in plan(merged[1]) and plan(merged[1]).count("Exchange") == 1
    rows = [sorted(map(repr, m.collect())) for m in merged]
    assert rows[0] == rows[1] and len(rows[0]) == 2
    assert raw.read_feed(spark, f"file://{tmp_path}", ["1999-01"], opened=False).schema["games"].dataType == closed.schema["games"].dataType
    (place / "feed=cut").mkdir()
    (place / "feed=cut" / "x.json").write_text('{"username": "D", "games": [{"uuid": "a"}, {"uu')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ_FILE"):
        bronze.explode_feed(raw.read_feed(spark, f"file://{tmp_path}", opened=False)).collect()


def test_queries_read_closed_documents(spark, tables):
    assert dict(q_bronze.feed(spark, tables).dtypes)["games"] == "array<string>"
    assert "array<struct" not in plan(contract.load_all()["feed_explode"].build(spark, tables))
