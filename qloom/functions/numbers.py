"""Numeric helpers whose results do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact(col: Column | str, scale: int = 2, precision: int = 18) -> Column:
    """A decimal view of a floating column, so that its sums are the same on every run."""
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal({precision},{scale})")


def mean(col: Column) -> Column:
    """Average as one division of an exact sum by the count (null for no values)."""
    n = F.count(col)
    return F.when(n > 0, F.sum(col).cast("double") / n)
