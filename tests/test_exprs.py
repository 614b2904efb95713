"""Column expressions against hand-written rows and the edge cases of the
source system's helpers (values worked out from its definitions)."""

import hashlib
import json
from datetime import datetime, timezone
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from gamelake.functions import exprs as X


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_result_score(spark):
    got = one_col(spark, ["", None, "win", "stalemate", "timeout", "agreed", "50move", "resigned"], X.result_score)
    assert got == [None, None, 1.0, 0.5, 0.0, 0.5, 0.5, 0.0]


def test_winner_color(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.5, 0.5), (0.0, 1.0), (None, 1.0)], "w double, b double")
    assert [r[0] for r in df.select(X.winner_color("w", "b")).collect()] == ["white", "draw", "black", None]


def _py_iso(v):
    try:
        return datetime.fromtimestamp(int(v), tz=timezone.utc).isoformat()
    except (TypeError, ValueError, OSError, OverflowError):
        return None


def test_epoch_to_iso(spark):
    vals = [None, "x", "0", "1767225600", "789000000", "-86400", "12.5", "99999999999999"]
    got = one_col(spark, vals, X.epoch_to_iso)
    assert got[:4] == [None, None, "1970-01-01T00:00:00+00:00", "2026-01-01T00:00:00+00:00"]
    assert got == [_py_iso(v) for v in vals]
    assert one_col(spark, ["2026-01-01T00:00:00+00:00", None, ""], X.iso_to_date_text) == ["2026-01-01", None, None]


def test_coerce_number(spark):
    assert one_col(spark, [None, "", "abc", "2500", " 7.5 "], X.coerce_number) == [None, None, None, 2500.0, 7.5]


def _py_opening(url):
    if not url:
        return None
    path = urlparse(url).path.rstrip("/")
    return path.split("/")[-1].replace("-", " ") if path else None


URLS = ["https://a.b/x/Y-Z/?q=1#f", "https://a.b/", None, "", "https://games.example/openings/Sicilian-Defense",
        "no-scheme/path/Last-One", "https://a.b/x;p", "https://a.b?x/y", "mailto:someone", "https://a.b/x/y//",
        "//host/only", "ftp://h/a-b-c;type=a", "relative"]


@pytest.mark.parametrize("url", URLS)
def test_opening_name_matches_url_parser(spark, url):
    assert one_col(spark, [url], X.opening_name) == [_py_opening(url)]


def test_accuracies(spark):
    vals = ["{}", "n/a", '{"white":91.2}', '{"white":"x","black":88}', None]
    assert one_col(spark, vals, X.has_accuracies) == [False, False, True, True, False]
    assert one_col(spark, vals, lambda c: X.accuracy_of(c, "white")) == [None, None, 91.2, None, None]
    assert one_col(spark, vals, lambda c: X.accuracy_of(c, "black")) == [None, None, None, 88.0, None]


def test_hash_bucket_matches_md5(spark):
    vals = ["g1-1", "https://x/y", "abc::Player1", "ü-unicode"]
    for n in (16, 7, 1, 0):
        exp = [f"{int(hashlib.md5(v.encode()).hexdigest()[:8], 16) % max(n, 1):02d}" for v in vals]
        assert one_col(spark, vals, lambda c: X.hash_bucket(c, n)) == exp


def test_month_list_hash_matches_json(spark):
    lists = [[], ["2024-01"], ["2023-11", "2024-01", "2024-02"]]
    df = spark.createDataFrame([(m,) for m in lists], "m array<string>")
    got = [r[0] for r in df.select(X.month_list_hash("m")).collect()]
    exp = [hashlib.sha256(json.dumps(m, sort_keys=True).encode()).hexdigest() for m in lists]
    assert got == exp


def test_archive_month(spark):
    vals = ["https://api/x/games/2024/1", "https://api/x/games/2024/11/", "2024/123", "single"]
    assert one_col(spark, vals, X.archive_month) == ["2024-01", "2024-11", "2024-123", None]


def test_round_like_matches_duckdb_on_ties(spark):
    import duckdb

    vals = [1.005, 2.675, -0.00003, 0.125, 1234.5678] + [i / 1000 + 0.0005 for i in range(0, 3000, 7)]
    for n in (2, 4):
        got = one_col(spark, vals, lambda c: X.round_like(c, n), "double")
        exp = [r[0] + 0.0 for r in duckdb.sql(
            f"select round(v, {n}) from (select unnest(?::double[]) as v)", params=[vals]).fetchall()]
        assert got == exp
    assert one_col(spark, [-0.00003], lambda c: X.round_like(c, 4), "double") == [0.0]


def test_month_key_and_filters(spark):
    df = spark.createDataFrame([("2024", "2"), ("2024", "12")], "year string, month string")
    assert [r[0] for r in df.select(X.month_key()).collect()] == ["2024-02", "2024-12"]
    assert df.filter(X.month_filter("2024-02")).count() == 1
    assert df.filter(X.month_filter(months=["2024-02", "2024-12"])).count() == 2
    assert df.filter(X.month_filter()).count() == 2


def test_bucket_text_is_padded_to_two_digits(spark):
    """Against the formatter, with more buckets than two digits name, and null."""
    df = spark.range(400).select(F.when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("v"))
    for n in (1, 7, 16, 256):
        h = F.conv(F.substring(F.md5("v"), 1, 8), 16, 10).cast("bigint") % n
        assert df.filter(~X.hash_bucket("v", n).eqNullSafe(F.format_string("%02d", h))).count() == 0


def test_accuracies_are_parsed_once(spark):
    from gamelake.operators import bronze
    side = F.struct(F.lit("a").alias("username"), F.lit("1").alias("rating"), F.lit("win").alias("result"))
    games = spark.createDataFrame([(x,) for x in ('{"white": 81.5, "black": "70"}', "{}", "null", "[1]", None, "12")], "accuracies string").select(
        "accuracies", side.alias("white"), side.alias("black"), F.lit(True).alias("rated"), F.array(F.lit("u")).alias("source_player_usernames"),
        *[F.lit("x").alias(c) for c in ("year", "month", "game_key", "url", "end_time", "time_class", "time_control", "rules", "eco", "initial_setup", "fen")],
        *[F.lit(True).alias(c) for c in ("has_pgn", "has_tcn")], *[F.lit(1).alias(c) for c in ("source_key_count", "source_player_count")])
    core = bronze.games_core_rows(games).select("has_accuracies", "white_accuracy", "black_accuracy")
    assert core._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert [tuple(r) for r in core.collect()] == [(True, 81.5, 70.0), *[(False, None, None)] * 5]
