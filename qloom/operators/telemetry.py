"""Metric, parameter and serving logs.

Metric rows are (run_id, ts, key, value, step); a run or key may hold much of the log, so every
operator reduces on the map side before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from qloom.functions.numbers import exact, mean
from qloom.functions.text import word_count


def param_log(runs: DataFrame, params: str, lists: str | None = None) -> DataFrame:
    """Parameter maps as rows (run_id, key, value); list values are joined by commas."""
    entries = F.map_entries(params)
    if lists:
        joined = F.transform(
            F.map_entries(lists),
            lambda e: F.struct(e["key"].alias("key"), F.array_join(e["value"], ",").alias("value")),
        )
        entries = F.concat(entries, joined)
    return runs.select("run_id", F.inline(entries))


def metric_numeric(logs: DataFrame, entries: str) -> DataFrame:
    """Logged maps as metric rows, numeric entries only."""
    rows = logs.select("run_id", "ts", "step", F.explode(entries).alias("key", "text"))
    return rows.withColumn("value", F.col("text").try_cast("double")).where(F.col("value").isNotNull()).drop("text")


def metric_latest(metrics: DataFrame) -> DataFrame:
    """Last value per run and key: the highest step, then the latest time."""
    last = F.max(F.struct("step", "ts", "value"))
    return (
        metrics.groupBy("run_id", "key")
        .agg(last.alias("last"))
        .select("run_id", "key", F.col("last.step").alias("step"), F.col("last.value").alias("value"))
    )


def best_checkpoint(metrics: DataFrame, key: str = "eval_loss") -> DataFrame:
    """Step with the lowest value of one metric per run, the earlier step on equal values."""
    lowest = F.min(F.struct("value", "step"))
    return (
        metrics.where((F.col("key") == key) & F.col("value").isNotNull())
        .groupBy("run_id")
        .agg(lowest.alias("low"))
        .select("run_id", F.col("low.step").alias("step"), F.col("low.value").alias("value"))
    )


def retain_last_k(
    checkpoints: DataFrame, k: int = 2, by: Sequence[str] = ("run_id",), best: DataFrame | None = None
) -> DataFrame:
    """The last ``k`` distinct steps of every run, and the ``best`` ones (run, step) beside them.

    A log has many rows per step, so steps are made distinct first. The rank is compared with a constant, so every
    task passes on at most ``k`` rows per run.
    """
    steps = checkpoints.select(*by, "step").where(F.col("step").isNotNull()).distinct()
    newest_first = Window.partitionBy(*by).orderBy(F.col("step").desc())
    kept = steps.withColumn("_place", F.row_number().over(newest_first)).where(F.col("_place") <= k).drop("_place")
    return kept if best is None else kept.unionByName(best.select(*by, "step")).distinct()


def serving_log(requests: DataFrame, sql: str = "sql", elapsed_ms: str = "elapsed_ms") -> DataFrame:
    """Serving records out of requests (ts, model_version, statement, time taken).

    The time is the measured one, in hundredths; the size of the answer is its number of words.
    """
    return requests.select(
        "ts",
        "model_version",
        F.col(sql).alias("sql"),
        F.round(elapsed_ms, 2).alias("execution_time_ms"),
        word_count(F.col(sql)).alias("tokens_generated"),
    )


def serving_rollup(log: DataFrame) -> DataFrame:
    """Requests, average time and tokens per model version."""
    return log.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n_requests"),
        mean(exact("execution_time_ms", 6, 24)).alias("avg_execution_time_ms"),
        F.sum("tokens_generated").alias("tokens_generated"),
    )
