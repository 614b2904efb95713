"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every operator assumes. All are settable on a live
# session, so a session built elsewhere (a cluster job, the test driver) is
# brought in line on first use.
SQL_CONF = {
    # ISO text and date maths are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Month/bucket partition values stay text ('02', not 2).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Re-running a month replaces only that month's partitions.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The game merge keeps a payload per group; its hash map takes so many groups
    # (some KB each) before it falls back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}

# Set where the session leaves it open: a task makes text of plain rows it has read, several times their bytes, and sorts it.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in TASK_BYTES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "gamelake") -> SparkSession:
    """Session for tests and local runs; a cluster passes its own builder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("GAMELAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that has none (tests) gets a private one; on a
    cluster every executor would write to its own disk, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="gamelake-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A stable path under the checkpoint root for data Spark derives from inputs."""
    return "/".join([checkpoint_root(spark), "gamelake", *parts])


def path_token(text: str) -> str:
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:12]

