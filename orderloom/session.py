"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from orderloom.sources.files import create_until_exit

# Read at run time by Spark SQL, so they can be set on a session that already exists.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: split the hot partition between tasks, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Snapshots, silver tables and marts: a third less is written than with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}

# Shuffles: a partition per so many bytes of input, for sessions that are told the input's size.
SHUFFLE_PARTITION = 128 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on to an existing session.

    What the caller has set stays. Nothing depends on an input, so DataFrames that are built but not
    yet run are not affected by later calls.
    """
    own = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in own:
            spark.conf.set(key, value)
    return spark


def get_session(
    app_name: str = "orderloom", master: str | None = None, input_bytes: int | None = None
) -> SparkSession:
    """A session; with the input's size its shuffles begin with enough partitions (AQE merges)."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if input_bytes:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions(input_bytes)),
        )
    return configure(builder.getOrCreate())


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions for a shuffle of the whole input, at any size."""
    return max(200, -(-input_bytes // SHUFFLE_PARTITION))


def started_partitions(spark: SparkSession) -> int:
    """Partitions that the session's shuffles begin with."""
    default = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", default))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for written intermediate tables, below the cluster's checkpoint folder.

    It is deleted when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="orderloom-")
        spark.sparkContext.setCheckpointDir(root)
    application = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    create_until_exit(spark, application)
    return f"{application}/{label}-{uuid.uuid4().hex}"
