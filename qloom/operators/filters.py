"""Row predicates. Each keeps the column bare, so the scan can use it."""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq}


def compare(df: DataFrame, col: str, op: str, value) -> DataFrame:
    """Rows whose column stands in relation ``op`` to a constant."""
    return df.where(_COMPARE[op](F.col(col), F.lit(value)))


def in_year(df: DataFrame, col: str, year: int) -> Column:
    """Half-open date range of one calendar year.

    A range on the bare column reaches the file statistics and partition values; a test on
    ``year(col)`` would not. Text dates are parsed, and texts that are no date do not match.
    """
    when = F.col(col)
    if isinstance(df.schema[col].dataType, T.StringType):
        when = F.try_to_timestamp(when)
    return (when >= F.lit(dt.date(year, 1, 1))) & (when < F.lit(dt.date(year + 1, 1, 1)))


def year_filter(df: DataFrame, col: str, year: int) -> DataFrame:
    return df.where(in_year(df, col, year))


def first_named(df: DataFrame, part: str) -> str | None:
    """First column whose name contains the given part."""
    return next((c for c in df.columns if part in c.lower()), None)


def status_filter(df: DataFrame, value: str, col: str | None = None) -> DataFrame:
    """Rows with one status. Without a column name, the first ``*status*`` column is used, if any."""
    col = col or first_named(df, "status")
    return df.where(F.col(col) == F.lit(value)) if col else df


def category_filter(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def conjunction(df: DataFrame, predicates: list[Column]) -> DataFrame:
    """Rows that meet every predicate; no predicate keeps all rows."""
    return df.where(reduce(operator.and_, predicates)) if predicates else df
