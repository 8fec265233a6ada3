"""From a question to rows: drafts run as Spark SQL on real tables, against the operators and DuckDB."""

import pytest
from pyspark.sql import functions as F

from qloom.operators import aggregates, drafts, filters, joins, ordering
from qloom.sources.tables import scan
from tests import oracle

DDL = """
CREATE TABLE customers (customer_id BIGINT PRIMARY KEY, name TEXT, segment_type TEXT, balance DECIMAL(12,2));
CREATE TABLE orders (order_id BIGINT PRIMARY KEY, customer_id BIGINT, order_date DATE, status TEXT, amount DECIMAL(12,2),
  FOREIGN KEY (customer_id) REFERENCES customers(customer_id));
CREATE TABLE order_items (order_id BIGINT REFERENCES orders(order_id), line_no INT, quantity DECIMAL(12,2),
  unit_price DECIMAL(15,2), PRIMARY KEY (order_id, line_no));
CREATE TABLE returns (return_no BIGINT PRIMARY KEY, order_id BIGINT REFERENCES orders(order_id));
"""
STATUS = {"F": "completed", "O": "pending", "P": "shipped"}
QUESTIONS = {
    "spend": "top 7 customers by total spend in 1997 for completed orders, with the number of distinct orders; the same spend should be sorted by customer_id asc",
    "never": "customers with completed orders in 1997 who never returned anything",
    "listing": "the 12 best customers of the Building segment with balance over 5000",
    "total": "how many orders per status in 1998",
}


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    lineitem = scan(spark, sf_dir, "lineitem")
    made = {
        "customers": scan(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.initcap("c_mktsegment").alias("segment_type"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        ),
        "orders": scan(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.element_at(status, F.col("o_orderstatus")).alias("status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        ),
        "order_items": lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(15,2)").alias("unit_price"),
        ),
        "returns": lineitem.where("l_returnflag = 'R'").select(
            F.xxhash64("l_orderkey", "l_partkey").alias("return_no"), F.col("l_orderkey").alias("order_id")
        ),
    }
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return made


@pytest.fixture(scope="module")
def answers(spark, tables):
    rows = [(i, DDL, q) for i, q in enumerate(QUESTIONS.values())]
    corpus = spark.createDataFrame(rows, "row_id long, ddl string, question string")
    drafted = {r.row_id: r.sql for r in drafts.draft_sql(corpus).collect()}
    return {name: drafted[i] for i, name in enumerate(QUESTIONS)}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_spend(spark, tables, answers):
    orders = tables["orders"].where((F.col("status") == "completed") & filters.in_year(tables["orders"], "order_date", 1997))
    spent = aggregates.spend(
        tables["customers"],
        orders,
        tables["order_items"],
        ["customer_id", "name"],
        aggregates.spend_expression("quantity", "unit_price"),
        ("customer_id", "customer_id"),
        ("order_id", "order_id"),
    )
    want = ordering.top_k(spent, "total_spend", 7, ["customer_id"])
    assert rows(spark.sql(answers["spend"])) == rows(want)
    assert want.count() == 7


def test_never(spark, tables, answers):
    orders = tables["orders"]
    want = joins.without_via(
        tables["customers"].select("customer_id", "name"),
        orders,
        tables["returns"],
        on=("customer_id", "customer_id"),
        bridge_on=("order_id", "order_id"),
        where=(F.col("status") == "completed") & filters.in_year(orders, "order_date", 1997),
    )
    assert rows(spark.sql(answers["never"])) == rows(want)
    assert want.count() > 0


def test_listing(spark, tables, answers):
    got = spark.sql(answers["listing"])
    want = ordering.top_k(
        tables["customers"].where("segment_type = 'Building' AND balance > 5000"), "balance", 12, ["customer_id"]
    )
    assert got.columns == ["customer_id", "name", "segment_type", "balance"]
    assert rows(got) == rows(want)


def test_total(spark, tables, answers, sf_dir):
    con = oracle.connect(sf_dir)
    want = con.execute("SELECT o_orderstatus, count(*) FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1").fetchall()
    assert rows(spark.sql(answers["total"])) == sorted((STATUS[s], n) for s, n in want)


def test_never_names_the_right_entities(spark):
    """Key and id differ, and the entity is the one before the "never"."""
    from qloom.operators import drafts

    ddl = """CREATE TABLE clubs (club_id INT PRIMARY KEY, club_name TEXT);
        CREATE TABLE members (member_id INT PRIMARY KEY, nickname TEXT, club_id INT REFERENCES clubs(club_id));"""
    asked = {1: "clubs that never had members", 2: "members that never had clubs"}
    corpus = spark.createDataFrame([(i, ddl, q) for i, q in asked.items()], "row_id long, ddl string, question string")
    sql = {r.row_id: r.sql for r in drafts.draft_sql(corpus).collect()}
    spark.createDataFrame([(1, "red"), (2, "blue"), (30, "green")], "club_id int, club_name string").createOrReplaceTempView("clubs")
    spark.createDataFrame([(30, "ann", 1), (31, "bo", 2), (1, "cy", 99)], "member_id int, nickname string, club_id int").createOrReplaceTempView("members")
    assert [tuple(r) for r in spark.sql(sql[1]).collect()] == [(30, "green")]
    assert [tuple(r) for r in spark.sql(sql[2]).collect()] == [(1, "cy")]
