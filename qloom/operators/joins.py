"""Inner joins along keys, and "never" questions as null-aware anti-joins.

No join here is forced to broadcast: Spark does so by itself where statistics or the finished
shuffle show that a side is small, and joins by shuffle otherwise.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Keys = Sequence[tuple[str, str]]


class NoJoinKey(ValueError):
    """Two tables have neither a foreign key nor an equal id column."""


def join_on(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Inner join on pairs of (left column, right column)."""
    if not on:
        raise NoJoinKey(f"no join key between {left.columns} and {right.columns}")
    return left.join(right, reduce(operator.and_, [left[a] == right[b] for a, b in on]), "inner")


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null, as groups do; the columns appear once."""
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(other, same, how).drop(*[f"_right_{c}" for c in on])


def shared_key(left: Sequence[str], right: Sequence[str]) -> str:
    """First id column that both tables have, in the order of the left one."""
    names = {c.lower() for c in right}
    for col in left:
        if col.lower().endswith("_id") and col.lower() in names:
            return col
    raise NoJoinKey(f"no shared id column between {list(left)} and {list(right)}")


def join_shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on the first shared id column, which appears once in the result."""
    return left.join(right, shared_key(left.columns, right.columns), "inner")


def join_star(primary: DataFrame, others: Sequence[tuple[DataFrame, Keys]]) -> DataFrame:
    """Primary table joined to every other one.

    Rows multiply: two detail tables of the same primary meet each other. Aggregate a detail table by
    its key first (``group_agg``) where one row per primary row is meant.
    """
    return reduce(lambda acc, other: join_on(acc, other[0], other[1]), others, primary)


def join_path(tables: dict[str, DataFrame], start: str, steps: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Join along all steps (from table, from column, to table, to column) of a path."""
    joined, seen = tables[start], {start}
    for source, source_col, target, target_col in steps:
        if source not in seen:
            raise NoJoinKey(f"step starts at {source}, which the path has not reached")
        if target not in seen:
            right = tables[target]
            joined = joined.join(right, tables[source][source_col] == right[target_col], "inner")
            seen.add(target)
    return joined


def without(entity: DataFrame, negative: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Entities whose key is NOT IN the keys of the negative table, with SQL's null rules.

    A plain anti-join keeps rows with a null key and ignores nulls among the negatives; NOT IN does
    neither. Both null rules are settled by two EXISTS tests that stop at the first row, and the keys
    themselves by a shuffled anti-join. Equal negative keys collapse before the shuffle.
    """
    key, neg_key = on
    keys = negative.select(F.col(neg_key).alias("_neg"))
    allowed = (F.col(key).isNotNull() & ~keys.where(F.col("_neg").isNull()).exists()) | ~keys.exists()
    return entity.where(allowed).join(keys.distinct(), F.col(key) == F.col("_neg"), "left_anti")


def without_via(
    entity: DataFrame,
    bridge: DataFrame,
    negative: DataFrame,
    on: tuple[str, str],
    bridge_on: tuple[str, str],
    where: Column | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Entities that have a qualifying bridge row but none that meets the negative table.

    The filter ``where`` holds for both uses of the bridge. An entity appears once per qualifying
    bridge row, or once in all with ``distinct``.
    """
    entity_key, bridge_key = on
    rows = bridge.where(where) if where is not None else bridge
    flagged = negative.select(F.col(bridge_on[1]).alias("_neg")).distinct()
    denied = rows.join(flagged, F.col(bridge_on[0]) == F.col("_neg"), "left_semi").select(
        F.col(bridge_key).alias("_denied")
    )
    links = rows.select(F.col(bridge_key).alias("_link"))
    if distinct:
        links = links.distinct()
    kept = links.where(~denied.where(F.col("_denied").isNull()).exists()).join(
        denied.distinct(), F.col("_link") == F.col("_denied"), "left_anti"
    )
    return entity.join(kept, F.col(entity_key) == F.col("_link"), "inner").drop("_link")
