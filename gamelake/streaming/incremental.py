"""Incremental bronze over newly landed feed files.

The daily ingest writes (or rewrites) feed documents into month folders and
then asks for those months to be materialised. Here a Structured Streaming
file source over the landing zone plays that trigger: each micro-batch holds
only the files that arrived since the last batch, and ``foreachBatch``
rebuilds bronze for exactly the months they touch. The month is rebuilt from
all of its raw files, not from the batch alone: a game's earlier sighting
may sit in a file of an earlier batch, and the first-wins merge needs every
sighting. The stream's checkpoint records which files were processed, so a
restarted job (or a lost driver) resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gamelake import schemas as SC
from gamelake.functions import exprs as X
from gamelake.plans import pipeline
from gamelake.session import configure, scratch_path


def touched_months(batch: DataFrame) -> list[str]:
    """Month keys present in a micro-batch (bounded by the calendar)."""
    return sorted(r[0] for r in batch.select(X.month_key("year", "month")).distinct().collect())


def start_bronze_stream(spark: SparkSession, raw_root: str, lake_root: str,
                        roster_members: DataFrame | None = None, checkpoint: str | None = None,
                        buckets: int = X.DEFAULT_BUCKETS, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    configure(spark)
    reader = (spark.readStream.schema(SC.FEED_DOC).option("multiLine", True)
              .option("basePath", raw_root))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.json(raw_root).select("year", "month", F.col("_metadata.file_path").alias("raw_key"))

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        months = touched_months(batch)
        if months:
            pipeline.build_bronze_months(spark, raw_root, lake_root, months, roster_members, buckets)

    ckpt = checkpoint or scratch_path(spark, "streams", "bronze", lake_root.strip("/").replace("/", "_"))
    writer = files.writeStream.foreachBatch(rebuild).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
