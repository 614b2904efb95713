"""Control-state transitions on hand-written state rows."""

import pytest
from pyspark.sql import functions as F

from gamelake.operators import months, state as ST


def roster(spark, rows):
    return spark.createDataFrame(rows, "title string, username string")


def test_upsert_remove_and_reappear(spark):
    s = ST.upsert_players(ST.empty_state(spark), roster(spark, [("GM", "a"), ("GM", "b")]), "2024-01-01")
    s = ST.upsert_players(s, roster(spark, [("GM", "a")]), "2024-01-02")
    got = {r.username: r for r in s.collect()}
    assert got["b"].status == "removed" and got["b"].removed_snapshot_date == "2024-01-02"
    s = ST.upsert_players(s, roster(spark, [("GM", "a"), ("GM", "b")]), "2024-01-03")
    got = {r.username: r for r in s.collect()}
    assert got["b"].status == "active" and got["b"].removed_snapshot_date is None
    assert got["b"].first_seen_snapshot_date == "2024-01-01" and got["b"].last_seen_snapshot_date == "2024-01-03"
    # removed and still absent: untouched
    s2 = ST.upsert_players(ST.upsert_players(s, roster(spark, [("GM", "a")]), "2024-01-04"), roster(spark, [("GM", "a")]),
                           "2024-01-05")
    assert {r.username: r.removed_snapshot_date for r in s2.collect()}["b"] == "2024-01-04"


def test_refresh_unchanged_hash_keeps_pending(spark):
    s = ST.upsert_players(ST.empty_state(spark), roster(spark, [("GM", "a"), ("GM", "b")]), "2024-01-01")
    lists = spark.createDataFrame([("a", ["https://h/p/a/games/2024/1", "https://h/p/a/games/2023/12"]),
                                   ("b", ["https://h/p/b/games/2024/1"])], "username string, archives array<string>")
    res = ST.refresh_results(lists, "2024-01", "2024-01-01 10:00:00")
    s1, ix1 = ST.apply_refresh(s, ST.empty_index(spark), res, "2024-01", "2024-01-01")
    a = {r.username: r for r in s1.collect()}["a"]
    assert a.latest_archive_month == "2024-01" and a.has_current_month_archive
    assert a.backfill_pending_count == 1 and a.archive_snapshot_key.endswith("/a/2024-01-01.json")
    assert {r.username: r.pending_backfill_months for r in ix1.collect()}["a"] == ["2023-12"]
    # same lists again: hash unchanged, key and count kept, index untouched
    forced = s1.withColumn("backfill_pending_count", F.lit(5))
    s2, ix2 = ST.apply_refresh(forced, ix1, res, "2024-01", "2024-01-02")
    a2 = {r.username: r for r in s2.collect()}["a"]
    assert a2.backfill_pending_count == 5 and a2.archive_snapshot_key.endswith("/a/2024-01-01.json")


def test_refresh_due_rules(spark):
    rows = [("a", "GM", "active", None, False), ("b", "GM", "active", "2024-01-01 11:00:00", True),
            ("c", "GM", "active", "2024-01-01 13:00:00", True), ("d", "GM", "active", "2023-12-01 00:00:00", False),
            ("e", "GM", "removed", None, False)]
    df = spark.createDataFrame(rows, "username string, title string, status string, t string, h boolean").select(
        "username", "title", "status", F.to_timestamp("t").alias("archive_last_checked_at"),
        F.col("h").alias("has_current_month_archive"))
    due = {r.username for r in df.filter(ST.refresh_due(df, "2024-01-02 12:00:00")).collect()}
    assert due == {"a", "b", "d"}


def test_month_validation():
    with pytest.raises(ValueError):
        months.month_words("2024-13")
    with pytest.raises(ValueError):
        months.month_words("2024-1")


def test_resolve_months_defaults_and_range(spark):
    r = [x.month_key for x in months.resolve_months(spark, None, {}, "2024-03-15").collect()]
    assert r == ["2024-03"]
    r = [x.month_key for x in months.resolve_months(spark, None, {"start_month": "2023-11", "end_month": "2024-02"},
                                                    "2024-03-15").collect()]
    assert r == ["2023-11", "2023-12", "2024-01", "2024-02"]
    with pytest.raises(ValueError):
        months.resolve_months(spark, None, {"start_month": "2023-11"}, "2024-03-15")


def test_two_titles_of_one_player(spark):
    """A promoted player (FM yesterday, IM today): only the active row is refreshed,
    one index row per player, a fetched month counts once."""
    from gamelake import schemas as SC

    rows = [("bo", "FM", "removed"), ("bo", "IM", "active"), ("cy", "GM", "active"), ("cy", "WGM", "active")]
    state = SC.conform(spark.createDataFrame(rows, "username string, title string, status string"), SC.PLAYER_STATE)
    url = "https://api.games.example/player/{}/games/2023/{}"
    lists = spark.createDataFrame([(u, [url.format(u, "11"), url.format(u, "12")]) for u in ("bo", "cy")], "username string, archives array<string>")
    res = ST.refresh_results(lists, "2024-01", "2024-01-01 10:00:00")
    s1, ix1 = ST.apply_refresh(state, ST.empty_index(spark), res, "2024-01", "2024-01-01")
    got = {(r.username, r.title): r for r in s1.collect()}
    assert got["bo", "FM"].archive_last_checked_at is None and got["bo", "IM"].backfill_pending_count == 2
    assert sorted(r.username for r in ix1.collect()) == ["bo", "cy"]
    queue = ST.backfill_queue(s1, ix1, "2024-01", None, None)
    assert queue.count() == 6
    raw_present = spark.createDataFrame([], "username string, month_key string")
    answers = spark.createDataFrame([("cy", "2023-11", 200, 3), ("cy", "2023-12", 500, 3), ("bo", "2023-11", 429, 2)],
                                    "username string, month_key string, status_code int, game_count int")
    ix2, result = ST.apply_backfill(queue, ix1, raw_present, answers)
    by = {(r.title, r.username): (r.processed, r.remaining) for r in result.collect()}
    assert by == {("IM", "bo"): (0, 2), ("GM", "cy"): (1, 1), ("WGM", "cy"): (0, 1)}
    assert sorted(r.username for r in ix2.collect()) == ["bo", "cy"]
    report = {r.title: (r.players, r.months_processed) for r in ST.backfill_report(s1, result).collect()}
    assert report == {"IM": (1, 0), "GM": (1, 1), "WGM": (1, 0)}


def test_failed_answers_leave_the_state(spark):
    answers = spark.createDataFrame([(200, 3), (200, None), (304, None), (404, None), (429, 5), (500, None), (None, None)],
                                    "status_code int, game_count int")
    got = [r.sync_status for r in ST.classify_responses(answers).collect()]
    assert got == ["updated", "empty", "not_modified", "empty", "error", "error", "error"]


def test_pivot_keeps_every_title(spark):
    from gamelake.operators import explore

    df = spark.createDataFrame([("2024-01", "GM", 1.0), ("2024-01", "XX", 2.0)], "month_key string, title string, v double")
    row = explore.pivot_by_title(df, "v").collect()[0]
    assert row.asDict() == {"month_key": "2024-01", "GM": 1.0, "XX": 2.0}
    assert explore.pivot_by_title(df, "v", ["GM"]).columns == ["month_key", "GM"]
