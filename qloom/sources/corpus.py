"""Corpora of (table definitions, question, answer) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.schemas import CORPUS


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A corpus with its fixed layout; nothing is inferred, so no pass over the files is spent on it."""
    return spark.read.schema(CORPUS).format(fmt).load(path)


def pairs_of_conversations(conversations: DataFrame, ddl) -> DataFrame:
    """User turns with the assistant turn that follows them, as corpus rows.

    An equi-join on (conversation, turn) rather than a window: a very long conversation then spreads
    over all tasks. ``row_id`` is the conversation times 2 ** 32 plus the turn, which must be a 32-bit number, so ids never
    collide; it is a decimal, which holds it for conversation ids of any size.
    """
    asked = conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    answered = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answered, ["conv_id", "turn"], "inner").select(
        F.when(F.col("turn").between(0, 2**32 - 1), F.col("conv_id").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("turn").cast("decimal(10,0)"))
        .otherwise(F.raise_error(F.lit("a turn is no 32-bit number")))
        .cast("decimal(38,0)")
        .alias("row_id"),
        F.lit(ddl).alias("ddl") if isinstance(ddl, str) else ddl.alias("ddl"),
        "question",
        "answer",
    )
