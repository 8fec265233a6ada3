"""Grouped and joined aggregates.

Sums go through a partial aggregate before every shuffle, so a key that holds much of the data
reaches the next stage as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.numbers import mean
from qloom.operators.ordering import sort_key, top_k

_FUNCTIONS = {"sum": F.sum, "avg": mean, "count": F.count}


def alias_for(func: str, col: str, revenue: bool = False) -> str:
    """Name of an aggregate column."""
    if revenue:
        return "total_revenue"
    return col.lower() if col.lower().startswith("total_") else f"{func}_{col}"


def group_agg(
    df: DataFrame,
    keys: Sequence[str],
    func: str,
    col: str,
    alias: str | None = None,
    distinct_col: str | None = None,
    approximate: bool = False,
) -> DataFrame:
    """One aggregate by key, largest first; a single row without keys.

    ``distinct_col`` adds the number of distinct values as ``distinct_<col>``; with ``approximate``
    a sketch of fixed size replaces the second shuffle that an exact count needs.
    """
    alias = alias or alias_for(func, col)
    out = [_FUNCTIONS[func](F.col(col)).alias(alias)]
    if distinct_col:
        count = F.approx_count_distinct if approximate else F.count_distinct
        out.append(count(F.col(distinct_col)).alias(f"distinct_{distinct_col}"))
    if not keys:
        return df.agg(*out)
    return df.groupBy(*keys).agg(*out).orderBy(sort_key(alias, True), *[sort_key(k, False) for k in keys])


def join_group_agg(
    primary: DataFrame,
    detail: DataFrame,
    on: tuple[str, str],
    keys: Sequence[str],
    func: str,
    col: str,
    alias: str | None = None,
    distinct_col: str | None = None,
) -> DataFrame:
    """Aggregate of a detail column by columns of the primary table.

    The detail table is reduced to one row per join key before it meets the primary, which gives the
    same result as joining first (every primary row meets the same sum) without moving its rows.
    A distinct count can be carried this way only if the join key is one of the grouping keys.
    """
    primary_key, detail_key = on
    alias = alias or alias_for(func, col)
    if distinct_col and primary_key not in keys:
        raise ValueError("a distinct count needs the join key among the grouping keys")
    parts = [F.sum(col).alias("_sum"), F.count(col).alias("_n")]
    if distinct_col:
        parts.append(F.count_distinct(F.col(distinct_col)).alias("_distinct"))
    per_key = detail.where(F.col(detail_key).isNotNull()).groupBy(F.col(detail_key).alias("_key")).agg(*parts)
    joined = primary.join(per_key, F.col(primary_key) == F.col("_key"), "inner")
    n = F.sum("_n")
    merged = {
        "sum": F.sum("_sum"),
        "count": n,
        "avg": F.when(n > 0, F.sum("_sum").cast("double") / n),
    }[func]
    out = [merged.alias(alias)]
    if distinct_col:
        out.append(F.max("_distinct").alias(f"distinct_{distinct_col}"))
    return joined.groupBy(*keys).agg(*out)


def spend_expression(qty: str, price: str, discount: str | None = None, discount_scale: int = 100) -> Column:
    """Quantity times price, less a discount given in percent (scale 100) or as a fraction (scale 1)."""
    amount = F.col(qty) * F.col(price)
    if discount is None:
        return amount
    rate = F.col(discount) if discount_scale == 1 else F.col(discount) / F.lit(discount_scale)
    return amount * (F.lit(1) - rate)


def spend(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    amount: Column | None,
    customer_on: tuple[str, str],
    item_on: tuple[str, str],
    alias: str = "total_spend",
) -> DataFrame:
    """Spend and number of distinct orders per customer.

    Items shrink to one row per order, then orders to one row per customer, then customers are looked
    up: each table is shuffled once, and a customer or order with very many rows arrives already
    summed. Without ``amount`` the items are counted. ``keys`` must contain the customer key. Orders are
    told apart by the key they share with their items, so counting them needs no exchange of its own.
    """
    customer_key, order_customer = customer_on
    order_key, item_key = item_on
    if customer_key not in keys:
        raise ValueError("the customer key must be one of the grouping keys")
    measure = F.sum(amount) if amount is not None else F.count(F.lit(1))
    per_order = items.groupBy(F.col(item_key).alias("_order")).agg(measure.alias("_spend"))
    per_customer = (
        orders.select(
            F.col(order_key).alias("_key"),
            F.col(order_customer).alias("_customer"),
        )
        .join(per_order, F.col("_key") == F.col("_order"), "inner")
        .groupBy("_customer")
        .agg(F.sum("_spend").alias("_spend"), F.count_distinct("_key").alias("_orders"))
    )
    return (
        customers.join(per_customer, F.col(customer_key) == F.col("_customer"), "inner")
        .groupBy(*keys)
        .agg(F.sum("_spend").alias(alias), F.max("_orders").alias("distinct_orders"))
    )


def spend_top_k(spent: DataFrame, k: int, id_col: str, alias: str = "total_spend") -> DataFrame:
    return top_k(spent, alias, k, ties=[id_col])
