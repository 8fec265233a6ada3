"""A second corpus of questions made from the part table, over schemas of a shop, with the drafts and readings expected of them.

A part's key picks the question, and its size and key vary years and numbers. The checking SQL states drafts and readings as
values per question and never reads the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qloom.functions.text import fill
from qloom.operators import drafts, features
from qloom.plans.registry import query
from qloom.session import spread
from qloom.sources.tables import scan

SHOP = (
    "CREATE TABLE customers (customer_id INT PRIMARY KEY, name TEXT, country TEXT);\n"
    "CREATE TABLE orders (order_id INT PRIMARY KEY, customer_id INT REFERENCES customers(customer_id), order_date DATE, "
    "total_amount DECIMAL(10,2), status TEXT);\n"
    "CREATE TABLE returns (return_id INT PRIMARY KEY, order_id INT REFERENCES orders(order_id), refund DECIMAL(10,2));\n"
    "CREATE TABLE tickets (ticket_id INT PRIMARY KEY, customer_id INT REFERENCES customers(customer_id), minutes INT, opened DATE);"
)
LONE = "CREATE TABLE gauges (gauge_id INT PRIMARY KEY, site TEXT, kind TEXT, level_m REAL)"
APART = "CREATE TABLE kites (sail TEXT, span INT); CREATE TABLE buoys (hull TEXT, draft_m INT)"
QUOTED = 'CREATE TABLE "price list" ("unit price" DECIMAL(8,2), "list id" INT PRIMARY KEY, region TEXT)'
CHAIN = "".join(
    f"CREATE TABLE {t} ({t}_id INT PRIMARY KEY, {t}_name TEXT{f', {up}_id INT REFERENCES {up}({up}_id)' if up else ''}{', yield_kg INT' if t == 'trees' else ''});"
    for up, t in zip((None, "nations", "states", "counties", "farms", "fields", "plots", "rows"), ("nations", "states", "counties", "farms", "fields", "plots", "rows", "trees"))
)


@dataclass(frozen=True)
class Case:
    """{y} is a year, {p} a number, {t} the same with separators of thousands, {n} the size. reading: comparisons | years | status."""

    ddl: str
    question: str
    draft: str | None
    reading: str = "||"
    problem: str | None = None


_LISTED = "SELECT order_id, status, total_amount, order_date FROM orders"
CASES = (
    Case(SHOP, "Orders not shipped", f"{_LISTED} WHERE status <> 'shipped' ORDER BY total_amount DESC", "||!shipped"),
    Case(SHOP, "orders placed before {y}", f"{_LISTED} WHERE year(order_date) < {{y}} ORDER BY total_amount DESC", "|< {y}|"),
    Case(
        SHOP, "paid orders over ${t}", f"{_LISTED} WHERE total_amount > {{p}} AND status = 'paid' ORDER BY total_amount DESC", "> {p}||paid"
    ),
    Case(
        SHOP,
        "orders with total_amount between {n} and {t}",
        f"{_LISTED} WHERE total_amount >= {{n}} AND total_amount <= {{p}} ORDER BY total_amount DESC",
        "total_amount >= {n},total_amount <= {p}||",
    ),
    Case(
        SHOP, "Orders between 1975 and {y}", f"{_LISTED} WHERE year(order_date) >= 1975 AND year(order_date) <= {{y}} ORDER BY total_amount DESC",
        "|>= 1975,<= {y}|",
    ),
    Case(
        SHOP,
        "average total_amount per country",
        "SELECT customers.country, AVG(orders.total_amount) AS total_amount FROM customers JOIN orders ON customers.customer_id = "
        "orders.customer_id GROUP BY customers.country ORDER BY total_amount DESC",
    ),
    Case(
        SHOP,
        "How many orders per customer?",
        "SELECT customers.customer_id, customers.name, COUNT(*) AS count_rows, COUNT(DISTINCT orders.order_id) AS count_distinct FROM customers "
        "JOIN orders ON customers.customer_id = orders.customer_id GROUP BY customers.customer_id, customers.name ORDER BY count_rows DESC",
    ),
    Case(
        SHOP,
        "Top {n} customers by total_amount since {y}",
        "SELECT customers.customer_id, customers.name, orders.total_amount FROM customers JOIN orders ON customers.customer_id = "
        "orders.customer_id WHERE year(orders.order_date) >= {y} ORDER BY orders.total_amount DESC LIMIT {n}",
        "|>= {y}|",
    ),
    Case(
        SHOP,
        "total refund and total minutes per customer",
        "SELECT customers.customer_id, customers.name, SUM(per_returns.sum_refund) AS sum_refund, SUM(per_tickets.sum_minutes) AS sum_minutes "
        "FROM customers LEFT JOIN (SELECT orders.customer_id AS link, SUM(returns.refund) AS sum_refund FROM orders JOIN returns ON "
        "orders.order_id = returns.order_id GROUP BY orders.customer_id) AS per_returns ON customers.customer_id = per_returns.link "
        "LEFT JOIN (SELECT tickets.customer_id AS link, SUM(tickets.minutes) AS sum_minutes FROM tickets GROUP BY tickets.customer_id) "
        "AS per_tickets ON customers.customer_id = per_tickets.link GROUP BY customers.customer_id, customers.name ORDER BY sum_refund DESC",
    ),
    Case(
        SHOP,
        "maximum refund of customers with tickets opened in {y}",
        "SELECT customers.customer_id, customers.name, MAX(per_returns.max_refund) AS max_refund FROM customers JOIN (SELECT orders.customer_id AS link, "
        "MAX(returns.refund) AS max_refund FROM orders JOIN returns ON orders.order_id = returns.order_id GROUP BY orders.customer_id) AS per_returns "
        "ON customers.customer_id = per_returns.link WHERE customers.customer_id IN (SELECT tickets.customer_id FROM tickets WHERE "
        "year(tickets.opened) = {y}) GROUP BY customers.customer_id, customers.name ORDER BY max_refund DESC",
        "|= {y}|",
    ),
    Case(
        SHOP, "customers in Chile with no more than {n} minutes",
        "SELECT customers.customer_id, customers.name, tickets.minutes FROM customers JOIN tickets ON customers.customer_id = tickets.customer_id "
        "WHERE tickets.minutes <= {n} AND customers.country = 'Chile'",
        "minutes <= {n}||",
    ),
    Case(
        LONE, "gauges of {y} not approved by site", "SELECT gauge_id, site, level_m FROM gauges ORDER BY level_m DESC", "|= {y}|!approved",
        "left out: year = {y}, approved, by site",
    ),
    Case(LONE, "Show all columns of gauges sorted by site", "SELECT * FROM gauges ORDER BY site ASC"),
    Case(APART, "total span of kites and buoys", None, problem="no join path"),
    Case(
        QUOTED, "the {n} lowest rows of price list by unit price", 'SELECT "list id", region, "unit price" FROM "price list" ORDER BY "unit price" ASC LIMIT {n}'
    ),
    Case(
        CHAIN,
        "total yield_kg per nation",
        "SELECT nations.nations_id, nations.nations_name, SUM(trees.yield_kg) AS sum_yield_kg FROM nations "
        + " ".join(f"JOIN {t} ON {up}.{up}_id = {t}.{up}_id" for up, t in zip(("nations", "states", "counties", "farms", "fields", "plots", "rows"), ("states", "counties", "farms", "fields", "plots", "rows", "trees")))
        + " GROUP BY nations.nations_id, nations.nations_name ORDER BY sum_yield_kg DESC",
    ),
)


def shop_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(row_id, ddl, question), one row per part."""
    part = spread(scan(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    number = F.col("p_partkey") + 1000
    values = {
        "n": F.col("p_size").cast("string"),
        "y": (F.col("p_size") + 1980).cast("string"),
        "p": number.cast("string"),
        "t": F.format_number(number, 0),
    }

    def pick(texts: list[str]) -> Column:
        out = F.when(F.lit(False), "")
        for k, text in enumerate(texts):
            out = out.when(F.col("p_partkey") % len(CASES) == k, fill(text, values))
        return out

    return part.select(F.col("p_partkey").alias("row_id"), pick([c.ddl for c in CASES]).alias("ddl"), pick([c.question for c in CASES]).alias("question"))


def _sql(text: str | None) -> str:
    if text is None:
        return "CAST(NULL AS VARCHAR)"
    out = "'" + text.replace("'", "''") + "'"
    for name, expr in (("n", "CAST(p_size AS VARCHAR)"), ("y", "CAST(p_size + 1980 AS VARCHAR)"), ("p", "CAST(p_partkey + 1000 AS VARCHAR)")):
        out = f"replace({out}, '{{{name}}}', {expr})" if "{" + name + "}" in text else out
    return out


def _expected(part) -> str:
    return f"CASE p_partkey % {len(CASES)} " + " ".join(f"WHEN {k} THEN {_sql(part(c))}" for k, c in enumerate(CASES)) + " END"


@query(
    "shop_drafts",
    f"SELECT p_partkey AS row_id, {_expected(lambda c: c.draft)} AS sql, {_expected(lambda c: c.problem)} AS problem FROM part",
)
def shop_drafts(spark: SparkSession, sf: str) -> DataFrame:
    return drafts.draft_sql(shop_corpus(spark, sf)).select("row_id", "sql", "problem")


@query("question_reading", f"SELECT p_partkey AS row_id, {_expected(lambda c: c.reading)} AS reading FROM part")
def question_reading(spark: SparkSession, sf: str) -> DataFrame:
    """Comparisons, year bounds and status of each question, as one text."""
    read = features.question_features(shop_corpus(spark, sf), ("comparisons", "years", "status", "status_not"))
    compared = F.transform("comparisons", lambda c: F.concat_ws(" ", F.nullif(c["col"], F.lit("")), c["op"], c["number"]))
    years = F.transform("years", lambda y: F.concat_ws(" ", y["op"], y["year"].cast("string")))
    status = F.coalesce(F.concat(F.when(F.col("status_not"), "!").otherwise(""), F.col("status")), F.lit(""))
    return read.select("row_id", F.concat_ws("|", F.array_join(compared, ","), F.array_join(years, ","), status).alias("reading"))
