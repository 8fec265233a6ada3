"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this package wants; a cluster's own values win where they are already set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs the next aggregate one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # checkpoint files go once nothing refers to their rows any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keys that a filtered side keeps are tested in the scan of the other side, ahead of its aggregate and exchange,
    # also where the filtered side is large
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.session.timeZone": "UTC",
    # keep the state of streams on disk, as the number of series has no bound
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(app: str = "qloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local session may fall back to a temporary folder:
    on a cluster a machine-local path is lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="qloom-"))
    return spark.sparkContext.getCheckpointDir()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition rows ahead of a step that does much work, or makes many rows, per byte it reads.

    The number of partitions is given, so that adaptive execution does not merge them by their size in
    bytes, which says little about the work to come.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
