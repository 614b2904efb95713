"""Tables behind a pointer: whole at every step, lost updates refused, parts kept, old files dropped."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from gamelake.operators import gold
from gamelake.plans import pipeline
from gamelake.session import scratch_path
from gamelake.sources import fixtures, lake, raw, snapshots


@pytest.fixture
def root(spark):
    return scratch_path(spark, "t-snap", uuid.uuid4().hex[:8])


def frame(spark, n, tag):
    return spark.range(n).select("id", F.lit(tag).alias("tag"), F.format_string("%02d", F.col("id") % 4).alias("part"))


def values(df):
    return sorted(tuple(r) for r in df.select("id", "tag", "part").collect())


def test_reader_sees_a_whole_table_at_every_step(spark, root, monkeypatch):
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    schema = frame(spark, 1, "x").schema
    assert snapshots.read(spark, root, schema).count() == 0
    snapshots.replace(frame(spark, 10, "one"), root)
    first = snapshots.read(spark, root)
    seen = []
    real = snapshots.commit

    def before_commit(*args):
        seen.append(values(snapshots.read(spark, root)))  # the next version's files are written, not yet named
        return real(*args)

    monkeypatch.setattr(snapshots, "commit", before_commit)
    snapshots.replace(frame(spark, 20, "two"), root)
    assert seen == [values(frame(spark, 10, "one"))]
    assert values(first) == values(frame(spark, 10, "one"))  # a plan made before the swap still runs
    assert values(snapshots.read(spark, root)) == values(frame(spark, 20, "two"))

    def crash(*args):
        raise OSError("gone")

    monkeypatch.setattr(snapshots, "commit", crash)
    with pytest.raises(OSError):
        snapshots.replace(frame(spark, 30, "three"), root)
    assert values(snapshots.read(spark, root)) == values(frame(spark, 20, "two"))


def test_first_write_is_not_visible_before_its_commit(spark, root, monkeypatch):
    monkeypatch.setattr(snapshots, "commit", lambda *args: snapshots.Version())
    snapshots.replace(frame(spark, 10, "one"), root)
    assert snapshots.read(spark, root, frame(spark, 1, "x").schema).count() == 0


def test_lost_update_is_refused(spark, root):
    start = snapshots.replace(frame(spark, 3, "one"), root)
    snapshots.replace(frame(spark, 4, "mine"), root, seen=start)
    with pytest.raises(snapshots.StaleVersion):
        snapshots.replace(frame(spark, 5, "theirs"), root, seen=start)
    assert values(snapshots.read(spark, root)) == values(frame(spark, 4, "mine"))
    # Many writers that saw the same version: one commits.
    seen, done = snapshots.head(spark, root), []

    def write(i):
        try:
            done.append(snapshots.commit(spark, root, seen, {"": f"data={i}"}).number)
        except snapshots.StaleVersion:
            done.append(None)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done, key=str) == [seen.number + 1] + [None] * 7


def test_parts_are_replaced_alone_and_old_files_go(spark, root):
    one = snapshots.replace(frame(spark, 20, "one"), root, "part")
    two = snapshots.replace(frame(spark, 20, "two").filter("part = '01'"), root, "part", ["01", "03"])
    assert {k for k in one.parts if one.parts[k] == two.parts.get(k)} == {"00", "02"}
    want = [r for r in values(frame(spark, 20, "one")) if r[2] in ("00", "02")] + [r for r in values(frame(spark, 20, "two")) if r[2] == "01"]
    assert values(snapshots.read(spark, root)) == sorted(want)
    assert values(snapshots.read(spark, root, at=one)) == values(frame(spark, 20, "one"))  # still there
    three = snapshots.replace(frame(spark, 20, "three").filter("part = '00'"), root, "part", ["00"])
    assert not raw.exists(spark, f"{root}/{one.parts['01']}") and raw.exists(spark, f"{root}/{one.parts['02']}")
    assert snapshots.numbers(spark, root) == [2, 3] and set(three.parts) == {"00", "01", "02"}
    for i in range(3):
        last = snapshots.replace(frame(spark, 2, str(i)), root, "part")
    fs, p = raw._fs(spark, root)
    assert len([st for st in fs.listStatus(p) if st.getPath().getName().startswith("data=")]) == 2
    assert snapshots.head(spark, root) == last
    empty = snapshots.replace(frame(spark, 0, "none"), root, "part")
    assert empty.parts == {} and snapshots.read(spark, root, frame(spark, 1, "x").schema).count() == 0


def test_plain_files_of_an_older_layout_are_read(spark, root):
    frame(spark, 5, "old").write.parquet(root)
    assert values(snapshots.read(spark, root)) == values(frame(spark, 5, "old"))


def test_late_month_rewrites_only_the_buckets_of_its_pairs(spark, sf, root):
    """One month's pairs change: the all-time mart keeps every other bucket's files and equals a full rebuild."""
    pairs = gold.h2h_monthly(gold.h2h_games(fixtures.view(spark, sf, "fx_games").withColumn("rules", F.lit(None).cast("string"))
                                            .withColumn("opening_name", F.lit(None).cast("string"))
                                            .withColumn("end_time_utc", F.lit(None).cast("string"))
                                            .withColumn("time_control", F.lit(None).cast("string"))
                                            .withColumn("winner_color", F.lit(None).cast("string"))))
    assert pipeline.build_pair_marts(spark, root, pairs, None) is None
    table = lake.path(root, lake.GOLD_SUMMARY)
    before = snapshots.head(spark, table)
    month = pairs.agg(F.min("month_key")).first()[0]
    some = [r["pair_key"] for r in pairs.filter(F.col("month_key") == month).select("pair_key").orderBy("pair_key").limit(3).collect()]
    # The month comes again with three pairs only, one of them with other counts.
    late = (pairs.filter((F.col("month_key") == month) & F.col("pair_key").isin(some))
            .withColumn("games_played", F.when(F.col("pair_key") == some[0], F.col("games_played") + 5).otherwise(F.col("games_played"))))
    touched = pipeline.build_pair_marts(spark, root, late, [month])
    after = snapshots.head(spark, table)
    month_buckets = {r[0] for r in pairs.filter(F.col("month_key") == month).select("pair_bucket").distinct().collect()}
    assert set(touched) == month_buckets and len(month_buckets) < len(before.parts)
    assert all(after.parts[b] == before.parts[b] for b in before.parts if b not in month_buckets)
    assert all(after.parts.get(b) != before.parts.get(b) for b in month_buckets)
    every = lake.read(spark, root, pipeline.PAIRS_MONTHLY)
    assert every.filter(F.col("month_key") == month).count() == 3
    full = gold.h2h_summary(every)
    got = lake.read_full(spark, root, lake.GOLD_SUMMARY).select(full.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
