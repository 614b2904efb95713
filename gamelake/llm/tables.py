"""Written intermediate tables in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gamelake.session import checkpoint_root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it back.

    A lost executor costs only the tasks since the last written table.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Parts:
    """A table written in parts, read as one scan over their folders.

    The plan does not grow with the number of parts, as a union's would.
    """

    def __init__(self, name: str):
        self.name, self.paths = name, []

    def add(self, df: DataFrame) -> DataFrame:
        """Write a part; the part alone."""
        self.spark, self.schema = df.sparkSession, df.schema
        self.paths.append(shared_path(self.spark, self.name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(self.schema).parquet(self.paths[-1])

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows: whole long texts stay within a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
