"""Appended logs and report files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from qloom.schemas import METRIC_LOG
from qloom.sources import committed


def append_metrics(metrics: DataFrame, path: str, batch: str | None = None) -> None:
    """Append metric rows, one folder per run.

    The rebalance step gives each run few files, and splits a run that is far larger than the others. With a batch id the
    rows are appended once, however often the call is repeated, also where an earlier try broke off half-way; such batches lie
    in a committed table beside the log.
    """
    rows = metrics.hint("rebalance", "run_id")
    if batch is None:
        rows.write.mode("append").partitionBy("run_id").parquet(path)
    else:
        committed.append(rows, f"{path}-batches", batch, ("run_id",))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows appended without a batch id and those of all committed batches."""
    batches = committed.read(spark, f"{path}-batches", METRIC_LOG)
    try:
        plain = spark.read.schema(METRIC_LOG).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return batches
    return plain.unionByName(batches)


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines, one per label."""
    report.write.mode("overwrite").json(path)
