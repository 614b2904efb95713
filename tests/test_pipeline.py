"""Layered build: idempotence and month replacement."""

import uuid

import pytest
from pyspark.sql import functions as F

from gamelake.plans import pipeline
from gamelake.session import scratch_path
from gamelake.sources import fixtures, lake, raw


def snapshot(spark, root, table):
    df = lake.read(spark, root, table)
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def test_rerun_is_idempotent_and_replaces_only_selected_months(spark, sf):
    raw_root = fixtures.landing_zone(spark, sf)
    root = scratch_path(spark, "test-lake", uuid.uuid4().hex[:8])
    members = fixtures.titles(spark, sf)
    pipeline.run(spark, raw_root, root, None, members)
    first = {t: snapshot(spark, root, t) for t in (lake.BRONZE_GAMES, lake.SILVER_FACTS, "gold/title_month_activity")}
    months = [r.month_key for r in lake.read(spark, root, lake.SILVER_GAMES).select("month_key").distinct()
              .orderBy("month_key").limit(2).collect()]
    rep = pipeline.run(spark, raw_root, root, months, members)
    assert rep.counts["unique_games"] > 0
    again = {t: snapshot(spark, root, t) for t in first}
    assert again == first
    summary = lake.read_full(spark, root, lake.GOLD_SUMMARY)
    monthly = lake.read(spark, root, "gold/head_to_head_monthly")
    assert summary.agg(F.sum("games_played")).first()[0] == monthly.agg(F.sum("games_played")).first()[0]


def test_month_without_raw_files_is_kept_and_empty_month_is_cleared(spark, sf):
    raw_root = fixtures.landing_zone(spark, sf)
    root = scratch_path(spark, "test-lake", uuid.uuid4().hex[:8])
    feed = raw.read_feed(spark, raw_root)
    month = feed.selectExpr("concat(year, '-', month) as k").orderBy("k").first()["k"]
    pipeline.run(spark, raw_root, root, [month])
    kept = snapshot(spark, root, lake.BRONZE_GAMES)
    assert kept
    assert pipeline.build_bronze_months(spark, raw_root, root, ["1900-01"], None) == {"unique_games": 0, "player_rows": 0}
    assert snapshot(spark, root, lake.BRONZE_GAMES) == kept
    # The same month again, now from documents without a usable game.
    empty_root = scratch_path(spark, "test-raw", uuid.uuid4().hex[:8])
    docs = feed.filter(F.concat("year", F.lit("-"), "month") == month).withColumn("games", F.expr("filter(games, g -> false)"))
    raw.write_feed(docs.drop("raw_key").withColumn("feed", F.lit("x")), empty_root)
    assert pipeline.build_bronze_months(spark, empty_root, root, [month], None)["unique_games"] == 0
    assert lake.read_bronze_games(spark, root).count() == 0 and lake.read_bronze_facts(spark, root).count() == 0


def test_cut_document_fails_the_read(spark, tmp_path):
    place = tmp_path / "year=2024" / "month=01"
    place.mkdir(parents=True)
    (place / "a.json").write_text('{"username": "a", "games": []}')
    (place / "b.json").write_text('{"username": "b", "games": [{"uu')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        raw.read_feed(spark, f"file://{tmp_path}").collect()
