"""Sorting and top-k with a complete order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def sort_key(col: str, descending: bool) -> Column:
    """Nulls count as smallest, whichever way the sort goes."""
    return F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_first()


def order_by(
    df: DataFrame,
    hint: str | None,
    numeric: Sequence[str] = (),
    id_col: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """Order by the hinted column, else the first numeric one, else the id descending.

    The id follows as last key, so that rows with equal values keep one order.
    """
    lead = hint or (numeric[0] if numeric else None)
    if lead is None:
        return df.orderBy(sort_key(id_col, True)) if id_col else df
    keys = [sort_key(lead, descending)]
    if id_col and id_col != lead:
        keys.append(sort_key(id_col, False))
    return df.orderBy(*keys)


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """First ``k`` rows by one column, ties by the given columns ascending.

    Every task keeps only its own first ``k`` rows before the final merge.
    """
    return df.orderBy(sort_key(by, descending), *[sort_key(t, False) for t in ties]).limit(k)
