"""The saved control state and the daily cycle: versions, lost updates, resumed and repeated days."""

import uuid

import pytest
from pyspark.sql import functions as F

from gamelake.operators import state as ST
from gamelake.plans import daily, pipeline
from gamelake.session import scratch_path
from gamelake.sources import snapshots, state_store

NOW = "2024-03-05 12:00:00"


@pytest.fixture
def root(spark):
    return scratch_path(spark, "t-daily", uuid.uuid4().hex[:8])


def roster(spark, **titles):
    return spark.createDataFrame([(t, "2024-03-05", p) for t, p in titles.items()], "title string, snapshot_date string, players array<string>")


def answers(spark, lists=(), games=(), raw=()):
    lists = spark.createDataFrame(list(lists), "username string, archives array<string>")
    games = spark.createDataFrame(list(games), "username string, month_key string, status_code int, etag string, game_count int")
    return daily.Answers(lambda due: lists.join(due.select("username").distinct(), "username"),
                         lambda req: games.join(req.select("username", "month_key"), ["username", "month_key"]),
                         spark.createDataFrame(list(raw), "username string, month_key string"))


def url(user, month):
    return f"https://games.example/player/{user}/games/{month.replace('-', '/')}"


def players(control):
    return {(r.title, r.username): r for r in control.players.collect()}


def test_lost_update(spark, root):
    """Two runs read the same state: the second save fails and the first one's stands."""
    one = ST.upsert_players(ST.empty_state(spark), spark.createDataFrame([("GM", "a")], "title string, username string"), "2024-01-01")
    start = state_store.commit(spark, root, state_store.read(spark, root), players=one, index=ST.empty_index(spark))
    mine = ST.upsert_players(start.players, spark.createDataFrame([("GM", "a"), ("GM", "b")], "title string, username string"), "2024-01-02")
    theirs = ST.upsert_players(start.players, spark.createDataFrame([("IM", "c")], "title string, username string"), "2024-01-02")
    state_store.commit(spark, root, start, players=mine)
    with pytest.raises(snapshots.StaleVersion):
        state_store.commit(spark, root, start, players=theirs)
    now = state_store.read(spark, root)
    assert now.version.number == 2 and set(players(now)) == {("GM", "a"), ("GM", "b")}
    assert now.index.count() == 0 and now.titles.count() == 0
    assert set(players(state_store.read(spark, root, start.version))) == {("GM", "a")}


def test_defaults_of_older_files(spark, root):
    first = state_store.commit(spark, root, state_store.read(spark, root), players=ST.empty_state(spark))
    name = first.version.parts["player_state"]
    spark.createDataFrame([("a", "GM")], "username string, title string").write.partitionBy("title").mode("overwrite").parquet(
        f"{root}/state/control/{name}")
    row = state_store.read(spark, root).players.first()
    assert (row.status, row.backfill_pending_count, row.has_current_month_archive) == ("active", 0, False)
    assert row.player_index_key == "state/player_index/username_prefix=a/username=a/index.json"


def test_a_day_for_a_player_on_two_rosters(spark, root):
    source = answers(spark, [("ann", [url("ann", m) for m in ("2023-11", "2023-12", "2024-03")]), ("bob", [])],
                     [("ann", "2024-03", 200, "e1", 7), ("ann", "2023-11", 429, None, None)], [("ann", "2023-12")])
    day = roster(spark, GM=["ann", "ann", None], IM=["ann", "bob", "cy"])
    report = {r.title: r for r in daily.run_day(spark, root, day, source, "2024-03-05", NOW).collect()}
    assert (report["IM"].active, report["IM"].new, report["IM"].refreshed, report["IM"].changed) == (3, 3, 2, 2)
    assert (report["GM"].updated, report["IM"].updated, report["GM"].backfill_months, report["IM"].backfill_months) == (1, 1, 1, 0)
    got = state_store.read(spark, root)
    state, index = players(got), {r.username: r for r in got.index.collect()}
    assert state["IM", "cy"].archive_last_checked_at is None and state["IM", "bob"].archive_hash is not None
    for title in ("GM", "IM"):
        row = state[title, "ann"]
        assert (row.current_month_key, row.current_month_etag, row.current_month_game_count) == ("2024-03", "e1", 7)
        assert (row.backfill_pending, row.backfill_pending_count) == (True, 1)  # 2023-11 was refused
    assert index["ann"].stored_months == ["2023-12"] and index["ann"].pending_backfill_months == ["2023-11"]
    # The same day again: nothing is due or new.
    again = {r.title: r for r in daily.run_day(spark, root, day, source, "2024-03-05", NOW).collect()}
    assert (again["GM"].new, again["GM"].refreshed, again["IM"].refreshed, again["GM"].backfill_months) == (0, 0, 0, 0)
    assert players(state_store.read(spark, root))["GM", "ann"].backfill_pending_count == 1
    # Next month: the current month becomes a stored one, and a player who left stays known.
    later = roster(spark, GM=["ann"], IM=["bob"])
    daily.run_day(spark, root, later, answers(spark), "2024-04-01", "2024-04-01 12:00:00")
    end = state_store.read(spark, root)
    assert {r.username: r.stored_months for r in end.index.collect()}["ann"] == ["2023-12", "2024-03"]
    assert players(end)["IM", "ann"].status == "removed" and players(end)["IM", "ann"].current_month_key is None
    assert {r.username: r.title for r in daily.title_lookup(spark, root).collect()} == {"ann": "GM", "bob": "IM", "cy": "IM"}


def test_a_failed_day_resumes(spark, root):
    def broken(requests):
        raise OSError("no answer")

    day = roster(spark, GM=["ann"])
    good = answers(spark, [("ann", [url("ann", "2024-03")])], [("ann", "2024-03", 200, "e", 3)])
    with pytest.raises(OSError):
        daily.run_day(spark, root, day, daily.Answers(good.lists, broken, good.raw_months), "2024-03-05", NOW)
    half = players(state_store.read(spark, root))["GM", "ann"]
    assert half.has_current_month_archive and half.current_month_key is None
    report = daily.run_day(spark, root, day, good, "2024-03-05", NOW).first()
    assert (report.new, report.refreshed, report.updated) == (0, 0, 1)
    assert players(state_store.read(spark, root))["GM", "ann"].current_month_game_count == 3


def test_a_title_without_a_document_is_left_alone(spark, root):
    daily.snapshot_rosters(spark, root, roster(spark, GM=["ann"], IM=["bob"]), "2024-03-05", NOW)
    daily.snapshot_rosters(spark, root, roster(spark, GM=[]), "2024-03-06", NOW)
    got = state_store.read(spark, root)
    assert {k: r.status for k, r in players(got).items()} == {("GM", "ann"): "removed", ("IM", "bob"): "active"}
    assert {r.title: r.latest_snapshot_date for r in got.titles.collect()} == {"GM": "2024-03-06", "IM": "2024-03-05"}


def test_build_takes_titles_from_the_state(spark, root):
    from gamelake.sources import lake, raw
    daily.snapshot_rosters(spark, root, roster(spark, GM=["ann"], IM=["bob"]), "2024-03-05", NOW)
    daily.snapshot_rosters(spark, root, roster(spark, IM=[]), "2024-03-06", NOW)
    side = F.struct(F.lit("bob").alias("username"), F.lit("2000").alias("rating"), F.lit("win").alias("result"))
    game = F.struct(F.lit("u1").alias("uuid"), F.lit("1709600000").alias("end_time"), side.alias("white"),
                    side.withField("username", F.lit("ann")).alias("black"))
    docs = spark.range(1).select(F.lit("bob").alias("username"), F.lit("2024").alias("year"), F.lit("03").alias("month"),
                                 F.lit("2024-03").alias("month_key"), F.lit(1).alias("game_count"), F.array(game).alias("games"), F.lit("bob").alias("feed"))
    raw.write_feed(docs, f"{root}/raw")
    pipeline.build_bronze_months(spark, f"{root}/raw", f"{root}/lake", ["2024-03"],
                                 state_store.read(spark, root).players.select("title", "username"))
    row = lake.read_bronze_games(spark, f"{root}/lake").first()
    assert (row.white_title, row.black_title) == ("IM", "GM")  # bob has left the roster and keeps his title here
