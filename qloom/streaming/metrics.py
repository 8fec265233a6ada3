"""The metric log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from qloom.operators.telemetry import metric_latest
from qloom.sources import committed


def metric_stream(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Metric files of a folder as a stream; new files are picked up as they arrive."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def table_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The files of a parquet table as a stream, whether the table is one file or a folder of part files."""
    table = spark.read.parquet(path)
    file = path.rstrip("/").rsplit("/", 1)[1]
    single = any(f.rsplit("/", 1)[1] == file for f in table.inputFiles()[:1])
    folder, pattern = (path.rstrip("/").rsplit("/", 1)[0], file) if single else (path, "*.parquet")
    return metric_stream(spark, folder, table.schema, pattern, files_per_batch)


LATEST = "run_id string, key string, step long, ts timestamp, value double"


def latest_stream(metrics: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the last value per run and key up to date in a committed table of changes at ``path``.

    The running maximum lives in the stream's state. Each batch writes only the series it changed, to a folder of its own, and
    commits it under the batch's number. A batch that is run again after a failure is committed once.
    """
    last = F.max(F.struct("step", "ts", "value")).alias("last")
    changed = metrics.groupBy("run_id", "key").agg(last).select("run_id", "key", "last.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        # few files of even size, whatever the number of state partitions
        committed.append(batch.hint("rebalance"), path, str(batch_id))

    return (
        changed.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Last value per run and key out of the table of changes."""
    return metric_latest(committed.read(spark, path, LATEST))


def compact_latest(spark: SparkSession, path: str) -> None:
    """Merge the changes in force to one row per run and key, in one folder that takes their place.

    Batches that are committed meanwhile stay beside it. Readers that began before go on with the old folders, until
    ``committed.clean`` deletes them. One folder alone is left as it is.
    """
    old = committed.newest(spark, path)
    if len(old.folders) > 1:
        latest = F.max(F.struct("step", "ts", "value")).alias("last")
        merged = committed.read(spark, path, LATEST, old).groupBy("run_id", "key").agg(latest).select("run_id", "key", "last.*")
        committed.replace(spark, path, old, merged.hint("rebalance"))
