"""Versioned state tables and the legacy re-layout job."""

import json
import uuid

from gamelake.operators import layout, state as ST
from gamelake.session import scratch_path
from gamelake.sources import raw, state_store


def test_versions_and_defaults(spark):
    root = scratch_path(spark, "t-state", uuid.uuid4().hex[:8])
    assert state_store.load(spark, root, "player_state").count() == 0
    s = ST.upsert_players(ST.empty_state(spark), spark.createDataFrame([("GM", "ab"), ("IM", "cd")],
                                                                          "title string, username string"), "2024-01-01")
    v1 = state_store.save(s, root, "player_state", "1")
    s2 = ST.upsert_players(state_store.load(spark, root, "player_state"),
                           spark.createDataFrame([("GM", "ab")], "title string, username string"), "2024-01-02")
    state_store.save(s2, root, "player_state", "2")
    assert state_store.versions(spark, root, "player_state") == [v1, "2"]
    got = {r.username: r for r in state_store.load(spark, root, "player_state").collect()}
    assert got["cd"].status == "removed" and got["ab"].backfill_pending_count == 0
    ix = spark.createDataFrame([("ab", None)], "username string, stored_months array<string>")
    state_store.save(ix, root, "player_index", "1")
    r = state_store.load(spark, root, "player_index").collect()[0]
    assert r.stored_months == [] and r.updated_at is not None


def test_relayout_execute(spark, tmp_path):
    legacy = tmp_path / "raw" / "player_games"
    for user, y, m, n in [("alice", "2024", "01", 2), ("alice", "2024", "02", 1), ("bob", "2023", "12", 3)]:
        d = legacy / user / y
        d.mkdir(parents=True, exist_ok=True)
        doc = {"username": user, "games": [{"uuid": f"{user}-{y}{m}-{i}", "url": None} for i in range(n)]}
        (d / f"{m}.json").write_text(json.dumps(doc))
    (legacy / "alice" / "notes.txt").write_text("{}")
    new_root = str(tmp_path / "new" / "player_games")
    plan = layout.relayout_execute(spark, str(tmp_path / "raw"), new_root, prefix="a")
    counts = {r.action: r["count"] for r in plan.groupBy("action").count().collect()}
    assert counts == {"move": 2, "unrecognized": 1}
    docs = raw.read_feed(spark, new_root).collect()
    assert sorted((d.year, d.month, d.username, d.game_count) for d in docs) == [
        ("2024", "01", "alice", 2), ("2024", "02", "alice", 1)]


def legacy_tree(base, docs):
    for key, text in docs.items():
        at = base / "raw" / "player_games" / key
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(text)


def test_relayout_is_counted_and_repeatable(spark, tmp_path):
    games = lambda n: [{"uuid": f"g{i}"} for i in range(n)]
    docs = {"ann/2024/01.json": json.dumps({"username": "ann", "games": games(2), "extra": {"kept": [1, "ü"]}}, indent=1, ensure_ascii=False),
            "ann/2024/02.json": json.dumps({"username": "ann", "games": games(1)})[:-3],
            "ann/2024/03.json": "", "ann/2024/04.json": "[1]", "bob/2024/01.json": json.dumps({"games": games(3)}), "bob/notes.txt": "{}"}
    legacy_tree(tmp_path, docs)
    legacy, new, moves = (str(tmp_path / n) for n in ("raw", "new", "moves"))

    def run(prefix, name):
        r = layout.relayout_tree(spark, legacy, new, moves, prefix, name).first()
        return r.planned, r.moved, r.failed, r.already_new, r.unrecognized

    # The empty file is not listed by Spark.
    assert run("ann", "1") == (3, 1, 2, 0, 0)
    assert run("", "2") == (3, 1, 2, 1, 1)
    assert run("", "3") == (2, 0, 2, 2, 1)
    found = raw.read_feed(spark, new).collect()
    assert sorted((d.feed, d.month, len(d.games)) for d in found) == [("ann", "01", 2), ("bob", "01", 3)]
    text = spark.read.text(f"{new}/year=2024/month=01/feed=ann", wholetext=True).first()["value"]
    assert text.strip() == docs["ann/2024/01.json"]  # fields outside the schema too
    # The cut document is mended: the next run moves it, alone.
    (tmp_path / "raw/player_games/ann/2024/02.json").write_text(json.dumps({"username": "ann", "games": games(1)}))
    assert run("ann", "4") == (2, 1, 1, 1, 0)
    rows = layout.relayout_ledger(spark, moves).collect()
    assert sorted((r.run, r.key[len("raw/player_games/"):], r.status) for r in rows if r.run == "4") == [
        ("4", "ann/2024/02.json", "moved"), ("4", "ann/2024/04.json", "failed")]
    assert raw.read_feed(spark, new).count() == 3


def test_relayout_after_a_crash_before_the_ledger(spark, tmp_path, monkeypatch):
    """Documents written, no ledger row: the next run finds them and doubles nothing."""
    legacy_tree(tmp_path, {f"p{i}/2024/01.json": json.dumps({"games": [{"uuid": f"u{i}"}]}) for i in range(5)})
    legacy, new, moves = (str(tmp_path / n) for n in ("raw", "new", "moves"))
    real, calls = layout.present_keys, []

    def once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("driver lost")
        return real(*args)

    monkeypatch.setattr(layout, "present_keys", once)
    try:
        layout.relayout_tree(spark, legacy, new, moves)
    except OSError:
        pass
    r = layout.relayout_tree(spark, legacy, new, moves).first()
    assert (r.planned, r.moved, r.already_new) == (0, 0, 5)
    assert raw.read_feed(spark, new).count() == 5


def test_relayout_reads_a_large_tree_as_a_whole(spark, tmp_path, monkeypatch):
    legacy_tree(tmp_path, {f"p{i}/2024/01.json": "{\"games\": []}" for i in range(6)})
    monkeypatch.setattr(layout, "PATHS", 3)
    r = layout.relayout_tree(spark, str(tmp_path / "raw"), str(tmp_path / "new"), str(tmp_path / "moves")).first()
    assert (r.planned, r.moved, r.failed) == (6, 6, 0)


def test_months_come_from_directories_alone(spark, tmp_path):
    for place, text in (("year=2024/month=01/feed=a", "{\"games\": []}"), ("year=2024/month=02/feed=b", "no json at all"), ("year=2023/month=12/feed=c", "{}")):
        (tmp_path / place).mkdir(parents=True)
        (tmp_path / place / "x.json").write_text(text)
    (tmp_path / "year=2024/month=05").mkdir()
    root = f"file://{tmp_path}"
    assert [r.month_key for r in raw.months_available(spark, root).collect()] == ["2023-12", "2024-01", "2024-02"]
    # A month run lists and reads that month only: the broken document of another month is not met.
    got = raw.read_feed(spark, root, ["2024-01", "2024-05", "1999-01"])
    assert got.inputFiles() == [f"file://{tmp_path}/year=2024/month=01/feed=a/x.json"]
    assert [(r.year, r.month, r.feed) for r in got.collect()] == [("2024", "01", "a")]
    assert raw.read_feed(spark, root, ["1999-01"]).columns == got.columns and raw.read_feed(spark, root, ["1999-01"]).count() == 0
    index = raw.file_index(spark, root, ["2024-02"]).collect()
    assert [(r.feed, r.length) for r in index] == [("b", len("no json at all"))]
    assert raw.file_index(spark, root).count() == 3 and raw.file_index(spark, root, ["1999-01"]).count() == 0
