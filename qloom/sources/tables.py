"""Base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder; columns and filters are pushed down by the caller's query."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
