"""Percentiles of a growing log from sketches that are merged, not from its old rows.

A sketch counts values in buckets whose width follows their size: a value keeps its ``BITS`` leading bits, so that a
bucket is named by its lowest value and is at most 1 / 2 ** (BITS - 1) of it wide. Counts of equal buckets add up, so sketches merge
in any order to the sketch of all rows. A percentile is the middle of the bucket that holds its place: it differs from
the value at that place by at most 1 / 2 ** BITS of it (0.4 % with 8 bits), besides the rounding of values to ``UNIT``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qloom.functions.numbers import exact
from qloom.sources import committed

BITS = 8
# values are counted in millionths
UNIT = 1_000_000
SKETCH = "n long, total decimal(38,6), buckets array<struct<low:long,n:long>>"


def _width(size: Column) -> Column:
    """How many numbers share the leading bits of one that isn't negative."""
    spare = F.greatest(F.length(F.bin(size)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.lit(1).cast("long"), spare)


def _bucket(units: Column) -> Column:
    """The number nearest to zero with the same sign, size and leading bits."""
    return units - units % _width(F.abs(units))


def latency_sketch(rows: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """One row per group: number and exact total of the values that aren't null, and their buckets in rising order.

    Values are counted per bucket first, which is combined before it moves, so that a group of any size is a bounded number of rows.
    """
    units = F.round(F.col(col) * UNIT).cast("long")
    counted = rows.where(F.col(col).isNotNull()).select(*by, _bucket(units).alias("low"), exact(col, 6, 24).alias("value"))
    buckets = counted.groupBy(*by, "low").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return buckets.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"), F.sort_array(F.collect_list(F.struct("low", "n"))).alias("buckets")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """One sketch per group out of many."""
    totals = F.struct(F.lit(None).cast("long").alias("low"), F.lit(0).cast("long").alias("n"))
    cells = sketches.select(*by, "total", F.posexplode_outer("buckets").alias("place", "bucket"))
    flat = cells.select(*by, F.coalesce("bucket", totals).alias("b"), F.when(F.coalesce("place", F.lit(0)) == 0, F.col("total")).alias("total"))
    buckets = flat.groupBy(*by, F.col("b.low").alias("low")).agg(F.sum("b.n").alias("n"), F.sum("total").alias("total"))
    return buckets.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("total").cast("decimal(38,6)").alias("total"),
        F.sort_array(F.collect_list(F.when(F.col("low").isNotNull(), F.struct("low", "n")))).alias("buckets"),
    )


def sketch_percentiles(sketches: DataFrame, by: Sequence[str], percentiles: Mapping[str, float]) -> DataFrame:
    """Number, average and percentiles of each group: the value at place floor(n * q), counted from 0, within the stated bound."""

    def middle(low: Column) -> Column:
        half = (_width(F.abs(low)) - 1) / 2
        return F.when(low < 0, low - half).otherwise(low + half) / UNIT

    def at(q: float) -> Column:
        place = F.floor(F.col("n") * F.lit(q))
        start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("low"))
        found = F.aggregate(
            "buckets",
            start,
            lambda s, b: F.struct(
                (s["before"] + b["n"]).alias("before"), F.coalesce(s["low"], F.when(s["before"] + b["n"] > place, b["low"])).alias("low")
            ),
        )
        return middle(found["low"])

    average = (F.col("total").cast("double") / F.col("n")).alias("avg_latency_ms")
    return sketches.select(*by, F.col("n").alias("n_samples"), average, *[at(q).alias(name) for name, q in percentiles.items()])


def append_sketch(rows: DataFrame, path: str, batch: str, by: Sequence[str], col: str) -> None:
    """Adds a batch of rows to a log of sketches, once."""
    committed.append(latency_sketch(rows, by, col).coalesce(1), path, batch)


def read_sketch(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The sketch of all batches; ``by`` is the schema of the grouping columns, as ``"model_version string"``."""
    names = [x.split()[0] for x in by.split(",")]
    return merge_sketches(committed.read(spark, path, f"{by}, {SKETCH}"), names)


def compact_sketch(spark: SparkSession, path: str, by: str) -> None:
    """Puts the merged sketch of the batches in force in their place; their ids stay known."""
    old = committed.newest(spark, path)
    if len(old.folders) > 1:
        names = [x.split()[0] for x in by.split(",")]
        committed.replace(spark, path, old, merge_sketches(committed.read(spark, path, f"{by}, {SKETCH}", old), names).coalesce(1))
