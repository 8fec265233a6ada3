"""Filters, joins, aggregates and orderings over the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.functions.numbers import exact
from qloom.operators import aggregates, filters, joins, ordering
from qloom.operators.listing import Roles, joined_listing, listing
from qloom.plans.registry import query
from qloom.sources.tables import scan

CUSTOMER = Roles(id="c_custkey", name="c_name", category=["c_mktsegment"], numeric=["c_acctbal"])


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("entity_listing", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def entity_listing(spark: SparkSession, sf: str) -> DataFrame:
    return listing(scan(spark, sf, "customer"), CUSTOMER)


@query(
    "order_by_hint",
    """
    SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
    ORDER BY c_acctbal ASC NULLS FIRST, c_custkey LIMIT 10
    """,
)
def order_by_hint(spark: SparkSession, sf: str) -> DataFrame:
    return listing(scan(spark, sf, "customer"), CUSTOMER, order="c_acctbal", descending=False, limit=10)


@query(
    "top_k",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10
    """,
)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    orders = scan(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.top_k(orders, "o_totalprice", 10, ties=["o_orderkey"])


@query(
    "top_k_tiebreak",
    "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC NULLS LAST, p_partkey LIMIT 20",
)
def top_k_tiebreak(spark: SparkSession, sf: str) -> DataFrame:
    part = scan(spark, sf, "part").select("p_partkey", "p_size")
    return ordering.top_k(part, "p_size", 20, ties=["p_partkey"])


LINE = ("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_gt", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def filter_gt(spark: SparkSession, sf: str) -> DataFrame:
    return filters.compare(scan(spark, sf, "lineitem"), "l_quantity", ">", 45).select(*LINE)


@query("filter_lt", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice < 1000")
def filter_lt(spark: SparkSession, sf: str) -> DataFrame:
    return filters.compare(scan(spark, sf, "part"), "p_retailprice", "<", 1000).select("p_partkey", "p_retailprice")


@query(
    "filter_year",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997",
)
def filter_year(spark: SparkSession, sf: str) -> DataFrame:
    return filters.year_filter(scan(spark, sf, "orders"), "o_orderdate", 1997).select("o_orderkey", "o_totalprice")


@query("filter_status", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_status(spark: SparkSession, sf: str) -> DataFrame:
    return filters.status_filter(scan(spark, sf, "orders"), "F").select("o_orderkey", "o_orderstatus")


@query("filter_category", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_category(spark: SparkSession, sf: str) -> DataFrame:
    return filters.category_filter(scan(spark, sf, "customer"), "c_mktsegment", "BUILDING").select(
        "c_custkey", "c_name"
    )


@query(
    "filter_conjunction",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F' AND o_totalprice > 200000
    """,
)
def filter_conjunction(spark: SparkSession, sf: str) -> DataFrame:
    orders = scan(spark, sf, "orders")
    wanted = [
        filters.in_year(orders, "o_orderdate", 1997),
        F.col("o_orderstatus") == "F",
        F.col("o_totalprice") > 200000,
    ]
    return filters.conjunction(orders, wanted).select("o_orderkey", "o_totalprice")


@query(
    "join_fk",
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def join_fk(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.join_on(scan(spark, sf, "customer"), scan(spark, sf, "orders"), [("c_custkey", "o_custkey")])
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(
    "join_shared_key",
    """
    SELECT c_custkey AS customer_id, c_mktsegment, o_orderkey AS order_id, o_orderpriority
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def join_shared_key(spark: SparkSession, sf: str) -> DataFrame:
    customers = scan(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment")
    orders = scan(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), "o_orderpriority"
    )
    return joins.join_shared(customers, orders)


@query(
    "joined_listing",
    "SELECT c_custkey, c_name, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey",
)
def joined_listing_query(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.join_on(scan(spark, sf, "customer"), scan(spark, sf, "orders"), [("c_custkey", "o_custkey")])
    return joined_listing(joined, CUSTOMER, ["o_totalprice"])


def price_per_order(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order, so that an order with very many lines meets the joins as a single row."""
    return (
        scan(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(exact("l_extendedprice")).alias("price"), F.count(F.lit(1)).alias("n_lines"))
    )


@query(
    "join_star",
    """
    SELECT o_orderpriority, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
           CAST(count(*) AS BIGINT) AS n_lines
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY o_orderpriority
    """,
)
def join_star(spark: SparkSession, sf: str) -> DataFrame:
    star = joins.join_star(
        scan(spark, sf, "orders"),
        [
            (price_per_order(spark, sf), [("o_orderkey", "l_orderkey")]),
            (scan(spark, sf, "customer"), [("o_custkey", "c_custkey")]),
        ],
    )
    return star.groupBy("o_orderpriority").agg(
        F.sum("price").cast("double").alias("sum_price"), F.sum("n_lines").alias("n_lines")
    )


@query(
    "join_path_chain",
    """
    SELECT r_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
    """,
)
def join_path_chain(spark: SparkSession, sf: str) -> DataFrame:
    tables = {t: scan(spark, sf, t) for t in ("orders", "customer", "nation", "region")}
    tables["lineitem"] = price_per_order(spark, sf)
    chain = joins.join_path(
        tables,
        "lineitem",
        [
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"),
        ],
    )
    return as_double(aggregates.group_agg(chain, ["r_name"], "sum", "price", "sum_price"), "sum_price")


@query(
    "anti_join_direct",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def anti_join_direct(spark: SparkSession, sf: str) -> DataFrame:
    return joins.without(
        scan(spark, sf, "orders"), scan(spark, sf, "lineitem"), ("o_orderkey", "l_orderkey")
    ).select("o_orderkey", "o_totalprice")


BRIDGE_ORACLE = """
    SELECT {distinct} c_custkey, c_name
    FROM customer JOIN orders o ON c_custkey = o.o_custkey
    WHERE o.o_orderstatus = 'F' AND year(o.o_orderdate) = 1997
      AND c_custkey NOT IN (
        SELECT o2.o_custkey FROM orders o2 JOIN lineitem ON o2.o_orderkey = l_orderkey
        WHERE l_returnflag = 'R' AND o2.o_orderstatus = 'F' AND year(o2.o_orderdate) = 1997)
"""


def bridge(spark: SparkSession, sf: str, distinct: bool) -> DataFrame:
    orders = scan(spark, sf, "orders")
    returned = scan(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return joins.without_via(
        scan(spark, sf, "customer").select("c_custkey", "c_name"),
        orders,
        returned,
        on=("c_custkey", "o_custkey"),
        bridge_on=("o_orderkey", "l_orderkey"),
        where=(F.col("o_orderstatus") == "F") & filters.in_year(orders, "o_orderdate", 1997),
        distinct=distinct,
    )


@query("anti_join_bridge", BRIDGE_ORACLE.format(distinct=""))
def anti_join_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return bridge(spark, sf, distinct=False)


@query("anti_join_bridge_distinct", BRIDGE_ORACLE.format(distinct="DISTINCT"))
def anti_join_bridge_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return bridge(spark, sf, distinct=True)


@query(
    "group_sum",
    """
    SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_l_extendedprice
    FROM lineitem GROUP BY l_returnflag
    """,
)
def group_sum(spark: SparkSession, sf: str) -> DataFrame:
    lines = scan(spark, sf, "lineitem").withColumn("l_extendedprice", exact("l_extendedprice"))
    out = aggregates.group_agg(lines, ["l_returnflag"], "sum", "l_extendedprice")
    return as_double(out, "sum_l_extendedprice")


@query(
    "group_avg",
    """
    SELECT o_orderpriority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_o_totalprice
    FROM orders GROUP BY o_orderpriority
    """,
)
def group_avg(spark: SparkSession, sf: str) -> DataFrame:
    orders = scan(spark, sf, "orders").withColumn("o_totalprice", exact("o_totalprice"))
    return aggregates.group_agg(orders, ["o_orderpriority"], "avg", "o_totalprice")


@query(
    "group_count",
    "SELECT event_type, CAST(count(value) AS BIGINT) AS count_value FROM events GROUP BY event_type",
)
def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.group_agg(scan(spark, sf, "events"), ["event_type"], "count", "value")


@query(
    "global_agg",
    "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_o_totalprice FROM orders",
)
def global_agg(spark: SparkSession, sf: str) -> DataFrame:
    orders = scan(spark, sf, "orders").withColumn("o_totalprice", exact("o_totalprice"))
    return as_double(aggregates.group_agg(orders, [], "sum", "o_totalprice"), "sum_o_totalprice")


def customer_orders(spark: SparkSession, sf: str, distinct_col: str | None) -> DataFrame:
    orders = scan(spark, sf, "orders").withColumn("o_totalprice", exact("o_totalprice"))
    out = aggregates.join_group_agg(
        scan(spark, sf, "customer"),
        orders,
        ("c_custkey", "o_custkey"),
        ["c_custkey", "c_name"],
        "sum",
        "o_totalprice",
        distinct_col=distinct_col,
    )
    return as_double(out, "sum_o_totalprice")


@query(
    "join_group_sum",
    """
    SELECT c_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
    """,
)
def join_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    return customer_orders(spark, sf, None)


@query(
    "group_count_distinct",
    """
    SELECT c_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_o_totalprice,
           CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS distinct_o_orderpriority
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
    """,
)
def group_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return customer_orders(spark, sf, "o_orderpriority")


SPEND_ORACLE = """
    SELECT c_custkey, c_name, CAST(sum({amount}) AS DOUBLE) AS total_spend,
           CAST(count(DISTINCT o_orderkey) AS BIGINT) AS distinct_orders
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997
    GROUP BY c_custkey, c_name
    ORDER BY sum({amount}) DESC NULLS LAST, c_custkey LIMIT 5
"""
AMOUNT = "CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(15,2))"


def spend_query(spark: SparkSession, sf: str, discounted: bool) -> DataFrame:
    orders = scan(spark, sf, "orders")
    wanted = (F.col("o_orderstatus") == "F") & filters.in_year(orders, "o_orderdate", 1997)
    items = scan(spark, sf, "lineitem").select(
        "l_orderkey",
        exact("l_quantity", 2, 12).alias("qty"),
        exact("l_extendedprice", 2, 15).alias("price"),
        exact("l_discount", 2, 4).alias("discount"),
    )
    spent = aggregates.spend(
        scan(spark, sf, "customer"),
        orders.where(wanted),
        items,
        ["c_custkey", "c_name"],
        aggregates.spend_expression("qty", "price", "discount" if discounted else None, discount_scale=1),
        customer_on=("c_custkey", "o_custkey"),
        item_on=("o_orderkey", "l_orderkey"),
    )
    return as_double(aggregates.spend_top_k(spent, 5, "c_custkey"), "total_spend")


@query("spend_top_k", SPEND_ORACLE.format(amount=AMOUNT))
def spend_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return spend_query(spark, sf, discounted=False)


@query(
    "spend_discounted_top_k",
    SPEND_ORACLE.format(amount=AMOUNT + " * (1 - CAST(l_discount AS DECIMAL(4,2)))"),
)
def spend_discounted_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return spend_query(spark, sf, discounted=True)
