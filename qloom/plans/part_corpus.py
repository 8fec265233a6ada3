"""A corpus of table definitions and questions made from the part table, and its expected reading.

Every part gives one row. Its type picks one of six settings; its size and key vary names, types,
limits, years and numbers. The checking SQL never reads the texts: it states the expected catalog and
features as values per setting, joined to the parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.functions.text import fill
from qloom.operators.features import STATUS_WORDS
from qloom.session import spread
from qloom.sources.tables import scan


@dataclass(frozen=True)
class Setting:
    """Texts for one part type. {n} is the size, {y} a year, {s} a status, {p} a number."""

    ddl: str
    question: str
    draft: str


SETTINGS = {
    "ECONOMY": Setting(
        ddl=(
            "CREATE TABLE customers (customer_id INT PRIMARY KEY, full_name VARCHAR(80), country VARCHAR(40), joined DATE);\n"
            "CREATE TABLE orders (order_id BIGINT PRIMARY KEY, customer_id INT, placed TIMESTAMP, order_status VARCHAR(12), "
            "FOREIGN KEY (customer_id) REFERENCES customers(customer_id));\n"
            "CREATE TABLE order_items (order_id BIGINT REFERENCES orders(order_id), line_no SMALLINT, quantity INT, "
            "unit_price DECIMAL(10,2), discount_{n} FLOAT, PRIMARY KEY (order_id, line_no))"
        ),
        question=(
            "Find the top {n} customers by total spend in {y} for {s} orders with discounts, and the number of distinct "
            "orders. Customers with the same spend should be ordered by customer_id asc."
        ),
        draft=(
            "SELECT customers.customer_id, customers.full_name, SUM(order_items.quantity * order_items.unit_price * "
            "(1 - order_items.discount_{n} / 100.0)) AS total_spend, COUNT(DISTINCT orders.order_id) AS distinct_orders "
            "FROM customers JOIN orders ON customers.customer_id = orders.customer_id "
            "JOIN order_items ON orders.order_id = order_items.order_id "
            "WHERE year(orders.placed) = {y} AND orders.order_status = '{s}' "
            "GROUP BY customers.customer_id, customers.full_name "
            "ORDER BY total_spend DESC, customers.customer_id ASC LIMIT {n}"
        ),
    ),
    "MEDIUM": Setting(
        ddl=(
            "create table customers (customer_id int primary key, full_name varchar(80));\n"
            "create table orders (order_id bigint primary key, customer_id int references customers(customer_id), "
            "placed date, status char(10) default 'open, new', fee_{n} numeric);\n"
            "create table returns (return_id int primary key, order_id bigint, why text, "
            "constraint fk_{n} foreign key (order_id) references orders(order_id));"
        ),
        question="List customers with {s} orders in {y} that never returned anything",
        draft=(
            "SELECT customers.customer_id, customers.full_name FROM customers "
            "JOIN orders ON customers.customer_id = orders.customer_id "
            "WHERE year(orders.placed) = {y} AND orders.status = '{s}' AND customers.customer_id NOT IN "
            "(SELECT orders.customer_id FROM orders JOIN returns ON orders.order_id = returns.order_id "
            "WHERE year(orders.placed) = {y} AND orders.status = '{s}')"
        ),
    ),
    "PROMO": Setting(
        ddl=(
            "CREATE TABLE depots (depot_id INT PRIMARY KEY, depot_name TEXT, city VARCHAR(30));\n"
            "CREATE TABLE trucks (truck_id INT PRIMARY KEY, depot_id INT REFERENCES depots(depot_id), brand VARCHAR(20));\n"
            "CREATE TABLE trips (trip_id BIGINT PRIMARY KEY, truck_id INT, started DATETIME, km_{n} DECIMAL(9,1), "
            "FOREIGN KEY (truck_id) REFERENCES trucks(truck_id));"
        ),
        question="Show the average km {n} for each depot in {y}, lowest first",
        draft=(
            "SELECT depots.depot_id, depots.depot_name, AVG(trips.km_{n}) AS avg_km_{n} FROM depots "
            "JOIN trucks ON depots.depot_id = trucks.depot_id JOIN trips ON trucks.truck_id = trips.truck_id "
            "WHERE year(trips.started) = {y} GROUP BY depots.depot_id, depots.depot_name ORDER BY avg_km_{n} DESC"
        ),
    ),
    "STANDARD": Setting(
        ddl=(
            "CREATE TABLE teams (team_id INT PRIMARY KEY, team_name TEXT, dept VARCHAR(30), UNIQUE (team_name));\n"
            "CREATE TABLE employees (emp_id INT PRIMARY KEY, full_name VARCHAR(80), "
            "team_id INT REFERENCES teams(team_id), pay_{n} DECIMAL(9), hired DATE);"
        ),
        question="Find the {n} best employees of the Berlin team with pay_{n} over {p}, hired in {y}",
        draft=(
            "SELECT employees.emp_id, employees.full_name FROM employees JOIN teams ON employees.team_id = teams.team_id "
            "WHERE employees.pay_{n} > {p} AND year(employees.hired) = {y} AND teams.dept = 'Berlin' "
            "ORDER BY employees.pay_{n} DESC LIMIT {n}"
        ),
    ),
    "LARGE": Setting(
        ddl=(
            "CREATE TABLE plans (plan_id UUID PRIMARY KEY, tier VARCHAR(20), mrr_{n} DECIMAL(10,2), state VARCHAR(12), "
            "begun DATE, open BOOLEAN, note JSON)"
        ),
        question="Calculate total MRR by tier in {y} for plans with mrr_{n} at least {p}",
        draft=(
            "SELECT tier, SUM(mrr_{n}) AS sum_mrr_{n} FROM plans WHERE mrr_{n} >= {p} AND year(begun) = {y} "
            "GROUP BY tier ORDER BY sum_mrr_{n} DESC"
        ),
    ),
    "SMALL": Setting(
        ddl=(
            'CREATE TABLE IF NOT EXISTS music."songs" (song_id INT PRIMARY KEY, title VARCHAR(200), genre CHAR(12), '
            "play_count BIGINT, rating_{n} REAL, CHECK (rating_{n} < greatest(5, (6))), released DATE)"
        ),
        question="Show {n} cheapest songs by play count with rating_{n} below {n}.5 since {y}",
        draft=(
            "SELECT song_id, title, genre, play_count, rating_{n}, released FROM songs "
            "WHERE rating_{n} < {n}.5 AND year(released) >= {y} ORDER BY play_count ASC LIMIT {n}"
        ),
    ),
}


def by_type(texts: dict[str, str], values: dict) -> F.Column:
    out = None
    for kind, text in texts.items():
        test = F.col("p_type") == kind
        body = fill(text, values)
        out = F.when(test, body) if out is None else out.when(test, body)
    return out


def part_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(row_id, kind, ddl, question, answer), one row per part."""
    # a few bytes per part become a kilobyte of text that is then read with patterns
    part = spread(scan(spark, sf, "part").select("p_partkey", "p_type", "p_size"), "p_partkey")
    words = F.array(*map(F.lit, STATUS_WORDS))
    values = {
        "n": F.col("p_size").cast("string"),
        "y": (F.col("p_size") + 1980).cast("string"),
        "s": F.get(words, (F.col("p_partkey") % len(STATUS_WORDS)).cast("int")),
        "p": (F.col("p_partkey") + 100).cast("string"),
    }
    return part.select(
        F.col("p_partkey").alias("row_id"),
        F.lower("p_type").alias("kind"),
        by_type({k: s.ddl for k, s in SETTINGS.items()}, values).alias("ddl"),
        by_type({k: s.question for k, s in SETTINGS.items()}, values).alias("question"),
        by_type({k: s.draft for k, s in SETTINGS.items()}, values).alias("answer"),
    )


# Expected catalog: type, table place, table, column place, column, type word, precision, scale, family,
# primary key, foreign key, its table, its column.
COLUMNS = """
    ('ECONOMY', 0, 'customers', 0, 'customer_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('ECONOMY', 0, 'customers', 1, 'full_name', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('ECONOMY', 0, 'customers', 2, 'country', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('ECONOMY', 0, 'customers', 3, 'joined', 'DATE', NULL, NULL, 'date', false, false, NULL, NULL),
    ('ECONOMY', 1, 'orders', 0, 'order_id', 'BIGINT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('ECONOMY', 1, 'orders', 1, 'customer_id', 'INT', NULL, NULL, 'numeric', false, true, 'customers', 'customer_id'),
    ('ECONOMY', 1, 'orders', 2, 'placed', 'TIMESTAMP', NULL, NULL, 'date', false, false, NULL, NULL),
    ('ECONOMY', 1, 'orders', 3, 'order_status', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('ECONOMY', 2, 'order_items', 0, 'order_id', 'BIGINT', NULL, NULL, 'numeric', true, true, 'orders', 'order_id'),
    ('ECONOMY', 2, 'order_items', 1, 'line_no', 'SMALLINT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('ECONOMY', 2, 'order_items', 2, 'quantity', 'INT', NULL, NULL, 'numeric', false, false, NULL, NULL),
    ('ECONOMY', 2, 'order_items', 3, 'unit_price', 'DECIMAL', 10, 2, 'numeric', false, false, NULL, NULL),
    ('ECONOMY', 2, 'order_items', 4, 'discount_{n}', 'FLOAT', NULL, NULL, 'numeric', false, false, NULL, NULL),
    ('MEDIUM', 0, 'customers', 0, 'customer_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('MEDIUM', 0, 'customers', 1, 'full_name', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('MEDIUM', 1, 'orders', 0, 'order_id', 'BIGINT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('MEDIUM', 1, 'orders', 1, 'customer_id', 'INT', NULL, NULL, 'numeric', false, true, 'customers', 'customer_id'),
    ('MEDIUM', 1, 'orders', 2, 'placed', 'DATE', NULL, NULL, 'date', false, false, NULL, NULL),
    ('MEDIUM', 1, 'orders', 3, 'status', 'CHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('MEDIUM', 1, 'orders', 4, 'fee_{n}', 'NUMERIC', 10, 0, 'numeric', false, false, NULL, NULL),
    ('MEDIUM', 2, 'returns', 0, 'return_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('MEDIUM', 2, 'returns', 1, 'order_id', 'BIGINT', NULL, NULL, 'numeric', false, true, 'orders', 'order_id'),
    ('MEDIUM', 2, 'returns', 2, 'why', 'TEXT', NULL, NULL, 'text', false, false, NULL, NULL),
    ('PROMO', 0, 'depots', 0, 'depot_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('PROMO', 0, 'depots', 1, 'depot_name', 'TEXT', NULL, NULL, 'text', false, false, NULL, NULL),
    ('PROMO', 0, 'depots', 2, 'city', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('PROMO', 1, 'trucks', 0, 'truck_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('PROMO', 1, 'trucks', 1, 'depot_id', 'INT', NULL, NULL, 'numeric', false, true, 'depots', 'depot_id'),
    ('PROMO', 1, 'trucks', 2, 'brand', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('PROMO', 2, 'trips', 0, 'trip_id', 'BIGINT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('PROMO', 2, 'trips', 1, 'truck_id', 'INT', NULL, NULL, 'numeric', false, true, 'trucks', 'truck_id'),
    ('PROMO', 2, 'trips', 2, 'started', 'DATETIME', NULL, NULL, 'date', false, false, NULL, NULL),
    ('PROMO', 2, 'trips', 3, 'km_{n}', 'DECIMAL', 9, 1, 'numeric', false, false, NULL, NULL),
    ('STANDARD', 0, 'teams', 0, 'team_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('STANDARD', 0, 'teams', 1, 'team_name', 'TEXT', NULL, NULL, 'text', false, false, NULL, NULL),
    ('STANDARD', 0, 'teams', 2, 'dept', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('STANDARD', 1, 'employees', 0, 'emp_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('STANDARD', 1, 'employees', 1, 'full_name', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('STANDARD', 1, 'employees', 2, 'team_id', 'INT', NULL, NULL, 'numeric', false, true, 'teams', 'team_id'),
    ('STANDARD', 1, 'employees', 3, 'pay_{n}', 'DECIMAL', 9, 0, 'numeric', false, false, NULL, NULL),
    ('STANDARD', 1, 'employees', 4, 'hired', 'DATE', NULL, NULL, 'date', false, false, NULL, NULL),
    ('LARGE', 0, 'plans', 0, 'plan_id', 'UUID', NULL, NULL, 'none', true, false, NULL, NULL),
    ('LARGE', 0, 'plans', 1, 'tier', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('LARGE', 0, 'plans', 2, 'mrr_{n}', 'DECIMAL', 10, 2, 'numeric', false, false, NULL, NULL),
    ('LARGE', 0, 'plans', 3, 'state', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('LARGE', 0, 'plans', 4, 'begun', 'DATE', NULL, NULL, 'date', false, false, NULL, NULL),
    ('LARGE', 0, 'plans', 5, 'open', 'BOOLEAN', NULL, NULL, 'none', false, false, NULL, NULL),
    ('LARGE', 0, 'plans', 6, 'note', 'JSON', NULL, NULL, 'other', false, false, NULL, NULL),
    ('SMALL', 0, 'songs', 0, 'song_id', 'INT', NULL, NULL, 'numeric', true, false, NULL, NULL),
    ('SMALL', 0, 'songs', 1, 'title', 'VARCHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('SMALL', 0, 'songs', 2, 'genre', 'CHAR', NULL, NULL, 'text', false, false, NULL, NULL),
    ('SMALL', 0, 'songs', 3, 'play_count', 'BIGINT', NULL, NULL, 'numeric', false, false, NULL, NULL),
    ('SMALL', 0, 'songs', 4, 'rating_{n}', 'REAL', NULL, NULL, 'numeric', false, false, NULL, NULL),
    ('SMALL', 0, 'songs', 5, 'released', 'DATE', NULL, NULL, 'date', false, false, NULL, NULL)
"""

# Expected roles: type, table, role, place, column.
ROLES = """
    ('ECONOMY', 'customers', 'id', 0, 'customer_id'), ('ECONOMY', 'customers', 'name', 0, 'full_name'),
    ('ECONOMY', 'customers', 'category', 0, 'country'), ('ECONOMY', 'customers', 'date', 0, 'joined'),
    ('ECONOMY', 'orders', 'id', 0, 'order_id'), ('ECONOMY', 'orders', 'date', 0, 'placed'),
    ('ECONOMY', 'orders', 'category', 0, 'order_status'),
    ('ECONOMY', 'order_items', 'id', 0, 'order_id'), ('ECONOMY', 'order_items', 'numeric', 0, 'quantity'),
    ('ECONOMY', 'order_items', 'numeric', 1, 'unit_price'), ('ECONOMY', 'order_items', 'numeric', 2, 'discount_{n}'),
    ('MEDIUM', 'customers', 'id', 0, 'customer_id'), ('MEDIUM', 'customers', 'name', 0, 'full_name'),
    ('MEDIUM', 'orders', 'id', 0, 'order_id'), ('MEDIUM', 'orders', 'date', 0, 'placed'),
    ('MEDIUM', 'orders', 'category', 0, 'status'), ('MEDIUM', 'orders', 'numeric', 0, 'fee_{n}'),
    ('MEDIUM', 'returns', 'id', 0, 'return_id'), ('MEDIUM', 'returns', 'name', 0, 'why'), ('MEDIUM', 'returns', 'text', 0, 'why'),
    ('PROMO', 'depots', 'id', 0, 'depot_id'), ('PROMO', 'depots', 'name', 0, 'depot_name'), ('PROMO', 'depots', 'category', 0, 'city'),
    ('PROMO', 'trucks', 'id', 0, 'truck_id'), ('PROMO', 'trucks', 'name', 0, 'brand'),
    ('PROMO', 'trips', 'id', 0, 'trip_id'), ('PROMO', 'trips', 'date', 0, 'started'), ('PROMO', 'trips', 'numeric', 0, 'km_{n}'),
    ('STANDARD', 'teams', 'id', 0, 'team_id'), ('STANDARD', 'teams', 'name', 0, 'team_name'), ('STANDARD', 'teams', 'category', 0, 'dept'),
    ('STANDARD', 'employees', 'id', 0, 'emp_id'), ('STANDARD', 'employees', 'name', 0, 'full_name'),
    ('STANDARD', 'employees', 'numeric', 0, 'pay_{n}'), ('STANDARD', 'employees', 'date', 0, 'hired'),
    ('LARGE', 'plans', 'id', 0, 'plan_id'), ('LARGE', 'plans', 'category', 0, 'tier'), ('LARGE', 'plans', 'category', 1, 'state'),
    ('LARGE', 'plans', 'numeric', 0, 'mrr_{n}'), ('LARGE', 'plans', 'date', 0, 'begun'),
    ('SMALL', 'songs', 'id', 0, 'song_id'), ('SMALL', 'songs', 'name', 0, 'title'), ('SMALL', 'songs', 'category', 0, 'genre'),
    ('SMALL', 'songs', 'numeric', 0, 'play_count'), ('SMALL', 'songs', 'numeric', 1, 'rating_{n}'), ('SMALL', 'songs', 'date', 0, 'released')
"""

# Expected join graph: type, place, from, its column, to, its column, kind.
EDGES = """
    ('ECONOMY', 0, 'orders', 'customer_id', 'customers', 'customer_id', 'fk'),
    ('ECONOMY', 1, 'customers', 'customer_id', 'orders', 'customer_id', 'fk'),
    ('ECONOMY', 2, 'order_items', 'order_id', 'orders', 'order_id', 'fk'),
    ('ECONOMY', 3, 'orders', 'order_id', 'order_items', 'order_id', 'fk'),
    ('ECONOMY', 4, 'customers', 'customer_id', NULL, 'customer_id', 'shared'),
    ('ECONOMY', 5, 'orders', 'order_id', NULL, 'order_id', 'shared'),
    ('ECONOMY', 6, 'orders', 'customer_id', NULL, 'customer_id', 'shared'),
    ('ECONOMY', 7, 'order_items', 'order_id', NULL, 'order_id', 'shared'),
    ('MEDIUM', 0, 'orders', 'customer_id', 'customers', 'customer_id', 'fk'),
    ('MEDIUM', 1, 'customers', 'customer_id', 'orders', 'customer_id', 'fk'),
    ('MEDIUM', 2, 'returns', 'order_id', 'orders', 'order_id', 'fk'),
    ('MEDIUM', 3, 'orders', 'order_id', 'returns', 'order_id', 'fk'),
    ('MEDIUM', 4, 'customers', 'customer_id', NULL, 'customer_id', 'shared'),
    ('MEDIUM', 5, 'orders', 'order_id', NULL, 'order_id', 'shared'),
    ('MEDIUM', 6, 'orders', 'customer_id', NULL, 'customer_id', 'shared'),
    ('MEDIUM', 7, 'returns', 'order_id', NULL, 'order_id', 'shared'),
    ('PROMO', 0, 'trucks', 'depot_id', 'depots', 'depot_id', 'fk'),
    ('PROMO', 1, 'depots', 'depot_id', 'trucks', 'depot_id', 'fk'),
    ('PROMO', 2, 'trips', 'truck_id', 'trucks', 'truck_id', 'fk'),
    ('PROMO', 3, 'trucks', 'truck_id', 'trips', 'truck_id', 'fk'),
    ('PROMO', 4, 'depots', 'depot_id', NULL, 'depot_id', 'shared'),
    ('PROMO', 5, 'trucks', 'truck_id', NULL, 'truck_id', 'shared'),
    ('PROMO', 6, 'trucks', 'depot_id', NULL, 'depot_id', 'shared'),
    ('PROMO', 7, 'trips', 'truck_id', NULL, 'truck_id', 'shared'),
    ('STANDARD', 0, 'employees', 'team_id', 'teams', 'team_id', 'fk'),
    ('STANDARD', 1, 'teams', 'team_id', 'employees', 'team_id', 'fk'),
    ('STANDARD', 2, 'teams', 'team_id', NULL, 'team_id', 'shared'),
    ('STANDARD', 3, 'employees', 'team_id', NULL, 'team_id', 'shared')
"""

# Expected paths from the first table: type, to, hops, route.
PATHS = """
    ('ECONOMY', 'customers', 'orders', 1, 'customers.customer_id = orders.customer_id'),
    ('ECONOMY', 'customers', 'order_items', 2,
     'customers.customer_id = orders.customer_id, orders.order_id = order_items.order_id'),
    ('MEDIUM', 'customers', 'orders', 1, 'customers.customer_id = orders.customer_id'),
    ('MEDIUM', 'customers', 'returns', 2,
     'customers.customer_id = orders.customer_id, orders.order_id = returns.order_id'),
    ('PROMO', 'depots', 'trucks', 1, 'depots.depot_id = trucks.depot_id'),
    ('PROMO', 'depots', 'trips', 2, 'depots.depot_id = trucks.depot_id, trucks.truck_id = trips.truck_id'),
    ('STANDARD', 'teams', 'employees', 1, 'teams.team_id = employees.team_id')
"""


def sql_case(texts: dict[str, str]) -> str:
    """Per type, an SQL expression."""
    return "CASE p_type " + " ".join(f"WHEN '{k}' THEN {e}" for k, e in texts.items()) + " END"


def sql_template(text: str) -> str:
    """An SQL string out of a setting's text."""
    out = "'" + text.replace("'", "''") + "'"
    for name, expr in (("n", "n"), ("y", "y"), ("s", "s"), ("p", "p")):
        if "{" + name + "}" in text:
            out = f"replace({out}, '{{{name}}}', {expr})"
    return out


STATUS_LIST = "[" + ", ".join(f"'{w}'" for w in STATUS_WORDS) + "]"
PARTS = f"""
    parts AS (
      SELECT p_partkey AS row_id, p_type, CAST(p_size AS VARCHAR) AS n, CAST(p_size + 1980 AS VARCHAR) AS y,
             ({STATUS_LIST})[(p_partkey % {len(STATUS_WORDS)}) + 1] AS s, CAST(p_partkey + 100 AS VARCHAR) AS p, p_partkey, p_size
      FROM part)
"""
SPEC_COLUMNS = f"""
    spec(p_type, table_ord, table_key, col_ord, col_name, dtype, "precision", "scale", family, is_pk, is_fk, fk_table, fk_column)
      AS (VALUES {COLUMNS}),
    cols AS (
      SELECT row_id AS schema_id, table_key, CAST(table_ord AS INTEGER) AS table_ord, CAST(col_ord AS INTEGER) AS col_ord,
             replace(col_name, '{{n}}', n) AS col_name, dtype, CAST("precision" AS INTEGER) AS "precision",
             CAST("scale" AS INTEGER) AS "scale", family, is_pk, is_fk, fk_table, fk_column
      FROM parts JOIN spec USING (p_type))
"""
