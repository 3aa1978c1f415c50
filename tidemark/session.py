"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # All day and interval arithmetic on zoned timestamps is done in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even where that costs a later operator its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows multiply after the exchange that places their key, so a small shuffle is still real work.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # A name that occurs twice in an object is no error to any reader of the bus: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, name: str = "tidemark") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-"))
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below the one the cluster names.

    A machine-local folder is used only by a local master; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-tidemark-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
