"""Text lengths in white-space words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from qloom.functions.text import word_count


def token_count(df: DataFrame, col: str, alias: str = "n_tokens") -> DataFrame:
    return df.withColumn(alias, word_count(F.col(col)).cast("long"))


def length_profile(
    df: DataFrame, col: str, by: Sequence[str], limits: Sequence[int] = (900, 1024, 2048), width: int = 256
) -> DataFrame:
    """Histogram of lengths per group, with the number of texts over each limit."""
    counted = token_count(df.select(*by, col), col).drop(col)
    over = [F.count_if(F.col("n_tokens") > n).alias(f"over_{n}") for n in limits]
    step = (F.floor(F.col("n_tokens") / width) * width).cast("long").alias("from_tokens")
    return counted.groupBy(*by, step).agg(F.count(F.lit(1)).alias("n_texts"), *over)
