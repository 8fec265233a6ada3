"""Staged computation of long column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def settled(df: DataFrame, *columns: str) -> DataFrame:
    """Fix columns that later steps use many times, or filter on.

    Spark may put a column's whole expression in the place of its name: into filters that it moves
    down, and into the body of array functions, where it runs once per element. Over several stages
    of text processing that multiplies. A one-element ``inline`` is a step no expression moves across.
    It needs no shuffle and gives one row per row.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def choose(*cases: tuple, other) -> Column:
    """The value of the first case (condition, value) that holds.

    It is ``CASE``, written as nested ``if``. Array functions aren't compiled, and there a ``CASE`` walks its list of branches
    from the start for each one it tries.
    """
    out = other if isinstance(other, Column) else F.lit(other)
    for condition, value in reversed(cases):
        out = F.call_function("if", condition, value if isinstance(value, Column) else F.lit(value), out)
    return out
