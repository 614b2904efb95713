"""The incremental trigger builds the same bronze tables as the batch build."""

import uuid

from gamelake.plans import pipeline
from gamelake.session import scratch_path
from gamelake.sources import fixtures, lake
from gamelake.streaming import incremental


def test_available_now_stream_matches_batch(spark, sf):
    raw_root = fixtures.landing_zone(spark, sf)
    members = fixtures.titles(spark, sf)
    tag = uuid.uuid4().hex[:8]
    streamed, batch = scratch_path(spark, "t-stream", tag), scratch_path(spark, "t-batch", tag)
    q = incremental.start_bronze_stream(spark, raw_root, streamed, members)
    q.awaitTermination(600)
    assert q.exception() is None
    pipeline.build_bronze_months(spark, raw_root, batch, None, members)
    for t in (lake.BRONZE_GAMES, lake.BRONZE_FACTS):
        a = lake.read(spark, streamed, t)
        b = lake.read(spark, batch, t)
        assert a.count() == b.count()
        assert a.exceptAll(b.select(a.columns)).count() == 0
