"""Bronze merge, enrichment and player rows on hand-written feed documents."""

import json

from pyspark.sql import functions as F

from gamelake import schemas as SC
from gamelake.operators import bronze
from gamelake.sources import raw


def game(uuid="g1", url="https://x/live/g1", pgn="", eco=None, acc=None, white="A", black="B",
         wres="win", bres="checkmated", end_time="1767225600", rating="2500"):
    return {"uuid": uuid, "url": url, "end_time": end_time, "time_class": "blitz", "time_control": "180",
            "rated": True, "rules": "standard", "eco": eco, "initial_setup": None, "fen": None, "pgn": pgn, "tcn": None,
            "accuracies": acc, "white": {"username": white, "rating": rating, "result": wres},
            "black": {"username": black, "rating": "2400", "result": bres}}


def feed_df(spark, docs):
    """docs: list of (raw_key, username, games)"""
    rows = [{"raw_key": k, "username": u, "year": "2026", "month": "01", "month_key": "2026-01",
             "game_count": len(g), "games": g} for k, u, g in docs]
    schema = SC.struct([("raw_key", SC.S)] + [(f.name, f.dataType) for f in SC.FEED_DOC.fields])
    return spark.createDataFrame(rows, schema)


def test_first_wins_then_truthy_fill(spark):
    docs = [("k1", "A", [game(pgn="", eco=None, acc="{}", white="A")]),
            ("k2", "B", [game(pgn="1. e4", eco="https://x/openings/Kings-Pawn", acc='{"white":91.2}', white="Z")])]
    g, _ = bronze.build_bronze(feed_df(spark, docs), None)
    r = g.collect()
    assert len(r) == 1
    r = r[0]
    assert r.white_username == "A"                 # first sighting wins
    assert r.has_pgn and r.opening_name == "Kings Pawn"  # filled by the later truthy values
    assert r.has_accuracies and r.white_accuracy == 91.2
    assert r.source_key_count == 2 and r.source_player_usernames == ["A", "B"]


def test_key_falls_back_to_url_and_drops_keyless(spark):
    docs = [("k1", "A", [game(uuid="", url="https://x/live/9"), game(uuid=None, url=None)])]
    g, _ = bronze.build_bronze(feed_df(spark, docs), None)
    assert [r.game_uuid for r in g.collect()] == ["https://x/live/9"]


def test_merge_is_input_order_independent(spark):
    docs = [(f"k{i}", f"U{i}", [game(uuid=f"g{j}", white=f"W{i}", pgn="p" if (i + j) % 3 else "")
                                for j in range(5)]) for i in range(6)]
    a, _ = bronze.build_bronze(feed_df(spark, docs), None)
    b, _ = bronze.build_bronze(feed_df(spark, list(reversed(docs))).repartition(7), None)
    key = ["year", "month", "game_uuid"]
    assert sorted(map(tuple, a.drop("bucket").orderBy(key).collect())) == sorted(
        map(tuple, b.drop("bucket").orderBy(key).collect()))


def test_title_priority_and_case_sensitive_enrich(spark):
    members = spark.createDataFrame([("IM", "A"), ("GM", "A"), ("WCM", "b"), ("XX", "C")], "title string, username string")
    lk = {r.username: r.title for r in bronze.title_lookup(members).collect()}
    assert lk == {"A": "GM", "b": "WCM"}
    docs = [("k1", "A", [game(white="A", black="B")])]
    g, f = bronze.build_bronze(feed_df(spark, docs), members)
    r = g.collect()[0]
    assert (r.white_title, r.black_title) == ("GM", None)
    rows = {x.username: x for x in f.collect()}
    assert rows["A"].is_titled_player and not rows["A"].is_titled_opponent
    assert rows["B"].rating_diff == -100.0


def test_player_rows_skip_missing_side(spark):
    docs = [("k1", "A", [game(white="A", black="")])]
    _, f = bronze.build_bronze(feed_df(spark, docs), None)
    assert [r.username for r in f.collect()] == ["A"]


def test_buckets_in_range(spark):
    docs = [("k1", "A", [game(uuid=f"g{j}") for j in range(200)])]
    g, f = bronze.build_bronze(feed_df(spark, docs), None, buckets=16)
    bs = {r.bucket for r in g.select("bucket").distinct().collect()}
    assert bs <= {f"{i:02d}" for i in range(16)} and len(bs) > 8


def test_read_feed_from_files(spark, tmp_path):
    root = tmp_path / "player_games" / "year=2026" / "month=01"
    root.mkdir(parents=True)
    doc = {"username": "A", "year": "2026", "month": "01", "month_key": "2026-01", "game_count": 1,
           "games": [dict(game(), end_time=1767225600, white={"username": "A", "rating": 2500, "result": "win"},
                          accuracies={"white": 90.5, "black": 80})]}
    (root / "username=A.json").write_text(json.dumps(doc, indent=2))
    feed = raw.read_feed(spark, str(tmp_path / "player_games"))
    g, _ = bronze.build_bronze(feed, None)
    r = g.collect()[0]
    assert r.end_time_utc == "2026-01-01T00:00:00+00:00" and r.white_rating == 2500.0
    assert r.white_accuracy == 90.5 and r.black_accuracy == 80.0
    assert feed.select(F.col("raw_key")).first()[0].endswith("username=A.json")


def test_repeated_games_of_a_document(spark):
    """Positions of later sightings in one array, against a plain loop; and files counted once either way."""
    import random
    rng = random.Random(2)
    docs = []
    for i in range(60):
        games = [(rng.choice([None, "", "u1", "u2", "u3", f"v{rng.randrange(30)}"]), rng.choice([None, "", "l1", "l2"])) for _ in range(rng.choice([0, 1, 5, 40]))]
        docs.append((f"k{i:02d}", "2024", "01", rng.choice([None, "", "ann", "bob"]), games))
    feed = spark.createDataFrame(docs, "raw_key string, year string, month string, username string, games array<struct<uuid:string,url:string>>")

    def plain(games):
        seen, out = set(), []
        for pos, (uuid, url) in enumerate(games):
            key = uuid or url
            if key and key in seen:
                out.append(pos)
            seen.add(key)
        return sorted(out)

    got = {r.raw_key: sorted(r.found) for r in feed.select("raw_key", bronze.repeated_positions("games").alias("found")).collect()}
    assert got == {d[0]: plain(d[4]) for d in docs}
    none = spark.createDataFrame([(None,)], "games array<struct<uuid:string,url:string>>")
    assert none.select(bronze.repeated_positions("games").alias("x")).first()["x"] is None
    occ = bronze.explode_feed(feed)
    for name in ("end_time", "time_class", "time_control", "rated", "rules", "white", "black", "accuracies", "eco", "fen", "initial_setup", "pgn", "tcn"):
        occ = occ.withColumn(name, F.lit(None).cast("string"))
    files = {}
    for key, _, _, _, games in docs:
        for uuid, url in games:
            if uuid or url:
                files.setdefault(uuid or url, set()).add(key)
    for rows in (occ, occ.drop("again")):
        assert {r.game_key: r.source_key_count for r in bronze.merge_games(rows).collect()} == {k: len(v) for k, v in files.items()}


def test_accuracies_are_objects_not_texts(spark, tmp_path):
    """A JSON text holding an object gives no accuracy; it still counts as a value that a later sighting does not fill."""
    values = ['{"white": 81.5, "black": "70"}', '"{\\"white\\": 50}"', '"n/a"', "{}", "null", "[1]", "12", None, '{"white": null}']
    games = [{"uuid": f"g{i}"} | ({} if v is None else {"accuracies": json.loads(v)}) for i, v in enumerate(values)]
    second = [{"uuid": f"g{i}", "accuracies": {"white": 1, "black": 2}} for i in range(len(values))]
    place = tmp_path / "year=2024" / "month=01"
    for name, listed in (("a", games), ("b", second)):
        (place / f"feed={name}").mkdir(parents=True)
        (place / f"feed={name}" / "x.json").write_text(json.dumps({"username": name, "games": listed}))
    core = bronze.games_core_rows(bronze.merge_games(bronze.explode_feed(raw.read_feed(spark, f"file://{tmp_path}"))))
    got = {r.game_uuid: (r.has_accuracies, r.white_accuracy, r.black_accuracy) for r in core.collect()}
    filled, nothing = (True, 1.0, 2.0), (False, None, None)
    assert got == {"g0": (True, 81.5, 70.0), "g1": nothing, "g2": nothing, "g3": filled, "g4": filled, "g5": nothing, "g6": nothing,
                   "g7": filled, "g8": (True, None, None)}
