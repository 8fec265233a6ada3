"""Connected components of an edge list, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qloom.llm.shared import cut, tidied


def _star(edges: DataFrame) -> DataFrame:
    """For each u of (u, v): (u, v, smallest of u and its v's). The minimum is combined before it moves."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least.select("u", F.least("u", "m").alias("m")), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b), the label being the smallest node reachable.

    Rounds of large-star and small-star steps, each of which keeps the components and draws their nodes
    nearer to the smallest, until the edges stay the same. Each round is cut by a checkpoint; the driver
    sees a count and a checksum per round, never an edge.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        # only now: Spark's scheduler holds the plan of a step until the next one is over
        tidied(now.sparkSession)
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        now = cut(
            small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
