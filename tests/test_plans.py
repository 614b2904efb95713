"""Physical-plan properties the scale design relies on."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from gamelake.operators import bronze, silver
from gamelake.plans import q_bronze
from gamelake.session import scratch_path
from gamelake.sources import lake


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_month_filter_reaches_scan_as_partition_filter_and_prunes_columns(spark):
    root = scratch_path(spark, "t-plan", uuid.uuid4().hex[:8])
    df = spark.createDataFrame([("2024", "01", "00", "g1", 1.0), ("2024", "02", "01", "g2", 2.0)],
                               "year string, month string, bucket string, game_uuid string, white_rating double")
    lake.write_bronze_games(df, root)
    p = plan(lake.read_bronze_games(spark, root, ["2024-02"]).select("game_uuid"))
    assert "PartitionFilters" in p and "month" in p.split("PartitionFilters")[1].split("\n")[0]
    read_schema = p.split("ReadSchema:")[1].split("\n")[0]
    assert "game_uuid" in read_schema and "white_rating" not in read_schema


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("year"), F.lit("01").alias("month"),
                                  (F.col("id") % 13).cast("string").alias("game_uuid"),
                                  F.col("id").cast("int").alias("source_key_count"),
                                  F.lit(1).alias("source_player_count"), F.lit("u").alias("game_url"))
    p = plan(silver.dedup_games(df))
    first_partial = p.index("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    physical = p.split("\n\n")[0]
    # the partial limit sits below (after, in print order) the exchange
    assert physical.index("Exchange") < physical.rindex("WindowGroupLimit")
    assert first_partial > 0


def test_merge_has_no_distinct_expand_and_keeps_pgn_text_out_of_shuffle(spark, sf):
    occ = bronze.explode_feed(q_bronze.feed(spark, sf))
    p = plan(bronze.merge_games(occ))
    assert "Expand" not in p
    import re
    sections = re.split(r"\n(?=\(\d+\) )", p)
    exchanges = [sec for sec in sections if re.match(r"\(\d+\) Exchange", sec)]
    assert exchanges
    for sec in exchanges:
        inputs = [ln for ln in sec.splitlines() if ln.startswith("Input")]
        assert inputs and not re.search(r"\bpgn#|\btcn#", inputs[0])


def exchanges(df) -> list[str]:
    """The executed plan's shuffles, one text each."""
    text = plan(df)
    import re
    return [sec for sec in re.split(r"\n(?=\(\d+\) )", text) if re.match(r"\(\d+\) Exchange", sec)]


def test_merge_is_one_exchange_and_no_sort_on_the_payload(spark, sf):
    merged = bronze.merge_games(bronze.explode_feed(q_bronze.feed(spark, sf)))
    text = plan(merged)
    assert len(exchanges(merged)) == 1
    assert "SortAggregate" not in text and "ObjectHashAggregate" in text and "Window" not in text
    assert "Sort [" not in text


def duplicated_games(spark):
    """Some 150 games, one of them in 500 rows, most in one, some in several with exact ties on the order columns."""
    df = spark.range(700).select(
        F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("00").alias("bucket"),
        F.when(F.col("id") < 500, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 150).cast("string"))).alias("game_uuid"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 2).cast("int")).alias("source_key_count"), F.lit(1).alias("source_player_count"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("u"), (F.col("id") % 3).cast("string"))).alias("game_url"),
        F.concat(F.repeat(F.lit("text"), 50), (F.col("id") % 11).cast("string")).alias("opening_name"))
    return df.unionByName(df.limit(1).withColumn("game_uuid", F.lit(None).cast("string")))


def test_late_dedup_ranks_repeated_keys_only_and_picks_the_same_rows(spark):
    root = scratch_path(spark, "t-plan", uuid.uuid4().hex[:8])
    lake.write_bronze_games(duplicated_games(spark).repartition(4), root)
    stg = silver.stage_games(lake.read_bronze_games(spark, root))
    late, ranked = silver.dedup_games(stg, late=True), silver.dedup_games(stg)
    assert late.columns == ranked.columns
    assert sorted(map(str, late.collect())) == sorted(map(str, ranked.collect()))
    assert late.count() == duplicated_games(spark).filter("game_uuid is not null").select("game_uuid").distinct().count()
    # The branch of the keys with one row shuffles keys only.
    keys = stg.groupBy(*silver.GAME_KEYS).count().filter("count > 1").select(*silver.GAME_KEYS)
    single = stg.join(F.broadcast(keys), list(silver.GAME_KEYS), "left_anti")
    moved = [sec for sec in exchanges(single) if "opening_name" in sec]
    assert exchanges(single) and not moved


def test_roster_rank_in_slices_equals_the_plain_rank(spark):
    rows = [("2024-01-01", "GM", f"p{i:04d}", 3000, (i * 7919) % 2500 + 1) for i in range(3000)]
    rows += [("2024-01-01", "GM", f"z{i}", 3000, None) for i in range(30)] + [("2024-01-01", "GM", "p0001", 3000, 1), ("2024-01-01", "IM", "a", 1, 9),
             (None, "IM", "a", 1, 9), ("2024-01-01", None, "b", 1, None), ("2024-01-02", "GM", None, 1, 4), ("2024-01-02", "GM", "x", 1, -3)]
    stg = spark.createDataFrame(rows, "snapshot_date string, title string, username string, snapshot_player_count int, snapshot_position int")
    got = sorted(map(tuple, silver.silver_roster(stg, slice_size=100).collect()), key=str)
    best = {}
    for d, t, u, c, p in rows:
        old = best.get((d, t, u))
        if old is None or (p is None, p or 0) < (old[1] is None, old[1] or 0):
            best[d, t, u] = (c, p)
    want, last = [], {}
    for (d, t, u), (c, p) in sorted(best.items(), key=lambda r: (str(r[0][0]), str(r[0][1]), r[1][1] is None, r[1][1] or 0, r[0][2] is None, r[0][2] or "")):
        last[d, t] = last.get((d, t), 0) + 1
        want.append((d, t, u, c, p, last[d, t]))
    assert got == sorted(want, key=str)


def test_latest_per_key_aggregates_keys_only(spark):
    from gamelake.operators import state as ST
    from gamelake.sources import raw
    lists = spark.createDataFrame([("ann", "raw/player_archives/ann/2024-01-01.json", ["x"]), ("ann", "raw/player_archives/ann/2023/12.json", ["y"]),
                                   ("bob", "raw/player_archives/bob/notes.json", []), (None, "k", ["z"])],
                                  "username string, raw_key string, archives array<string>")
    docs = spark.createDataFrame([("GM", "a/2024-01-01", ["p"]), ("GM", "a/2024-01-02", ["q"]), ("IM", "b", None)],
                                 "title string, raw_key string, players array<string>")
    latest, roster = raw.latest_archive_list(lists), ST.latest_roster(docs)
    assert sorted((r.username, r.archives) for r in latest.collect()) == [("ann", ["x"]), ("bob", [])]
    assert sorted((r.title, str(r.players)) for r in roster.collect()) == [("GM", "['q']"), ("IM", "None")]
    for df in (latest, roster):
        assert "max_by" not in plan(df)
