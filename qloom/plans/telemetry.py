"""Run and serving logs, read from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.operators import sketches, telemetry
from qloom.plans.registry import query
from qloom.session import work_folder
from qloom.sources.logs import append_metrics, read_metrics
from qloom.sources.tables import scan
from qloom.streaming.metrics import compact_latest, latest_stream, read_latest, table_stream


def as_metrics(events: DataFrame) -> DataFrame:
    """Events as metric rows: the user is the run, the type the key, the id the step."""
    return events.select(
        F.col("user_id").cast("string").alias("run_id"),
        "ts",
        F.col("event_type").alias("key"),
        "value",
        F.col("event_id").alias("step"),
    )


@query(
    "param_log",
    """
    SELECT CAST(user_id AS VARCHAR) AS run_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'modules', event_type || ',' || lower(event_type || '_proj') FROM events
    """,
)
def param_log(spark: SparkSession, sf: str) -> DataFrame:
    runs = scan(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.from_json("props", "map<string,string>").alias("params"),
        F.create_map(
            F.lit("modules"), F.array("event_type", F.lower(F.concat("event_type", F.lit("_proj"))))
        ).alias("lists"),
    )
    return telemetry.param_log(runs, "params", "lists")


@query(
    "metric_numeric",
    """
    SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS step, 'k' AS key,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), event_id, 'value', value FROM events
    """,
)
def metric_numeric(spark: SparkSession, sf: str) -> DataFrame:
    logs = scan(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        "ts",
        F.col("event_id").alias("step"),
        F.map_concat(
            F.from_json("props", "map<string,string>"),
            F.create_map(F.lit("value"), F.col("value").cast("string"), F.lit("kind"), F.col("event_type")),
        ).alias("entries"),
    )
    return telemetry.metric_numeric(logs, "entries").drop("ts")


LATEST = """
    SELECT run_id, key, step, value FROM (
      SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key, event_id AS step, value,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC, ts DESC) AS place
      FROM events)
    WHERE place = 1
"""


@query("metric_latest", LATEST)
def metric_latest(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.metric_latest(as_metrics(scan(spark, sf, "events")))


@query(
    "best_checkpoint",
    """
    SELECT run_id, step, value FROM (
      SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS step, value,
             row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS place
      FROM events WHERE event_type = 'error')
    WHERE place = 1
    """,
)
def best_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.best_checkpoint(as_metrics(scan(spark, sf, "events")), "error")


@query(
    "retain_last_k",
    """
    SELECT run_id, step FROM (
      SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS step,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
      FROM events)
    WHERE place <= 2
    """,
)
def retain_last_k(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.retain_last_k(as_metrics(scan(spark, sf, "events")).select("run_id", "step"))


@query(
    "serving_rollup",
    """
    SELECT event_type AS model_version, CAST(count(*) AS BIGINT) AS n_requests,
           CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_execution_time_ms,
           CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS tokens_generated
    FROM events GROUP BY event_type
    """,
)
def serving_rollup(spark: SparkSession, sf: str) -> DataFrame:
    log = scan(spark, sf, "events").select(
        "ts",
        F.col("event_type").alias("model_version"),
        F.col("value").alias("execution_time_ms"),
        F.get_json_object("props", "$.k").try_cast("int").alias("tokens_generated"),
    )
    return telemetry.serving_rollup(log)


@query("metric_stream_latest", LATEST)
def metric_stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    stream = as_metrics(table_stream(spark, f"{sf.rstrip('/')}/events.parquet"))
    folder = work_folder(spark, "metric-latest")
    latest_stream(stream, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    compact_latest(spark, f"{folder}/table")
    return read_latest(spark, f"{folder}/table")


@query("metric_log", LATEST)
def metric_log(spark: SparkSession, sf: str) -> DataFrame:
    """Metric rows appended to a shared log in two batches, one of them twice, and read back."""
    rows = as_metrics(scan(spark, sf, "events"))
    # one run per event type, as a run has a folder of its own
    log = rows.select(F.col("key").alias("run_id"), "ts", F.col("run_id").alias("key"), "value", "step")
    folder = f"{work_folder(spark, 'metric-log')}/log"
    for batch in ("even", "odd", "even"):
        append_metrics(log.where("step % 2 = 0" if batch == "even" else "step % 2 = 1"), folder, batch)
    back = read_metrics(spark, folder)
    swapped = back.select(F.col("key").alias("run_id"), "ts", F.col("run_id").alias("key"), "value", "step")
    return telemetry.metric_latest(swapped)


@query(
    "serving_log",
    r"""
    SELECT ts, event_type AS model_version, props AS sql, round(value, 2) AS execution_time_ms,
           len(list_filter(string_split_regex(props, '\s+'), lambda w: w <> '')) AS tokens_generated
    FROM events
    """,
)
def serving_log(spark: SparkSession, sf: str) -> DataFrame:
    requests = scan(spark, sf, "events").select(
        "ts", F.col("event_type").alias("model_version"), F.col("props").alias("sql"), F.col("value").alias("elapsed_ms")
    )
    return telemetry.serving_log(requests).withColumn("tokens_generated", F.col("tokens_generated").cast("long"))


@query(
    "retain_last_and_best",
    """
    WITH steps AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS run_id, event_id // 10 AS step FROM events),
    last AS (SELECT run_id, step FROM (
      SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS place FROM steps) WHERE place <= 2),
    best AS (SELECT run_id, step FROM (
      SELECT CAST(user_id AS VARCHAR) AS run_id, event_id // 10 AS step,
             row_number() OVER (PARTITION BY user_id ORDER BY value, event_id // 10) AS place
      FROM events WHERE event_type = 'error') WHERE place = 1)
    SELECT run_id, step FROM last UNION SELECT run_id, step FROM best
    """,
)
def retain_last_and_best(spark: SparkSession, sf: str) -> DataFrame:
    """Ten events a step: the last two steps of a run, and its best one."""
    logged = as_metrics(scan(spark, sf, "events")).withColumn("step", F.expr("step div 10"))
    return telemetry.retain_last_k(logged, best=telemetry.best_checkpoint(logged, "error"))


@query(
    "latency_sketch",
    """
    WITH units AS (
      SELECT event_type AS model_version, value, CAST(round(value * 1000000) AS BIGINT) AS u FROM events WHERE value IS NOT NULL),
    sized AS (SELECT *, CAST(1 AS BIGINT) << greatest(length(bin(abs(u))) - 8, 0) AS step FROM units),
    buckets AS (
      SELECT model_version, u - u % step AS low, min(step) AS step, count(*) AS n, sum(CAST(value AS DECIMAL(24,6))) AS total
      FROM sized GROUP BY 1, 2),
    running AS (
      SELECT *, sum(n) OVER (PARTITION BY model_version ORDER BY low) AS upto, sum(n) OVER (PARTITION BY model_version) AS n_all,
             sum(total) OVER (PARTITION BY model_version) AS total_all, (low + sign(low) * (step - 1) / 2.0) / 1000000 AS middle FROM buckets)
    SELECT model_version, CAST(any_value(n_all) AS BIGINT) AS n_samples, CAST(any_value(total_all) AS DOUBLE) / any_value(n_all) AS avg_latency_ms,
           arg_min(middle, low) FILTER (WHERE upto > floor(n_all * 0.5)) AS p50_latency_ms,
           arg_min(middle, low) FILTER (WHERE upto > floor(n_all * CAST(0.95 AS DOUBLE))) AS p95_latency_ms
    FROM running GROUP BY model_version
    """,
)
def latency_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Latencies appended as sketches in four batches, one of them twice, with a compaction between, and read without their rows."""
    rows = scan(spark, sf, "events").select("event_id", F.col("event_type").alias("model_version"), "value")
    folder, by = work_folder(spark, "latency-sketch"), "model_version string"
    for batch in (0, 1, 1, 2, 3):
        sketches.append_sketch(rows.where(F.col("event_id") % 4 == batch), folder, str(batch), ["model_version"], "value")
        if batch == 2:
            sketches.compact_sketch(spark, folder, by)
    places = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}
    return sketches.sketch_percentiles(sketches.read_sketch(spark, folder, by), ["model_version"], places)
