"""Match-records analytics on Spark.

Raw per-player monthly game feeds and roster snapshots are turned into bronze,
silver and gold tables with plain DataFrame transforms; control-state tables
decide what to refresh or backfill; ``operators.explore`` answers the
interactive questions. Every public operator is ``DataFrame -> DataFrame``.
"""

__all__ = ["session"]
