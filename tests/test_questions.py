"""Question features and draft SQL on our own questions, over the shapes a user asks for."""

import duckdb
import pytest
from pyspark.sql import functions as F

from qloom.operators import drafts, features

STAFF = """CREATE TABLE workers (worker_id INT PRIMARY KEY, full_name VARCHAR(60), dept VARCHAR(30), wage DECIMAL(9,2),
    total_sales DECIMAL(12,2), began DATE, status VARCHAR(10));"""
SONGS = "CREATE TABLE songs (song_id INT PRIMARY KEY, title TEXT, genre TEXT, play_count INT, rating FLOAT, released DATE)"
BILLS = "CREATE TABLE bills (bill_id INT PRIMARY KEY, payer_name TEXT, total DECIMAL(10,2), issued DATE)"
LABS = "CREATE TABLE samples (code INT, weight INT)"
TICKETS = "CREATE TABLE tickets (ticket_id INT PRIMARY KEY, subject TEXT, priority TEXT)"
TEAMS = """CREATE TABLE squads (squad_id INT PRIMARY KEY, squad_name TEXT, dept TEXT);
    CREATE TABLE players (player_id INT PRIMARY KEY, nickname TEXT, squad_id INT REFERENCES squads(squad_id), score INT, joined DATE);"""
SHOP = """CREATE TABLE customers (customer_id INT PRIMARY KEY, name TEXT, town TEXT, since DATE);
    CREATE TABLE makers (maker_id INT PRIMARY KEY, maker_label TEXT, founded DATE);
    CREATE TABLE lamps (lamp_id INT PRIMARY KEY, lamp_title TEXT, maker_id INT REFERENCES makers(maker_id), watts INT);
    CREATE TABLE orders (order_id INT PRIMARY KEY, customer_id INT, order_date DATE, status TEXT, courier TEXT,
        FOREIGN KEY (customer_id) REFERENCES customers(customer_id));
    CREATE TABLE order_items (order_id INT REFERENCES orders(order_id), lamp_id INT REFERENCES lamps(lamp_id),
        quantity INT, unit_price DECIMAL(10,2), discount_percent DECIMAL(5,2), PRIMARY KEY (order_id, lamp_id));
    CREATE TABLE repairs (repair_id INT PRIMARY KEY, lamp_id INT REFERENCES lamps(lamp_id), mended_on DATE, cost DECIMAL(12,2));
    CREATE TABLE returns (return_id INT PRIMARY KEY, order_id INT REFERENCES orders(order_id), back_on DATE, fault TEXT);"""
CHAIN = """CREATE TABLE regions (region_id INT PRIMARY KEY, region_name TEXT, area TEXT);
    CREATE TABLE towns (town_id INT PRIMARY KEY, region_id INT REFERENCES regions(region_id), mayor TEXT);
    CREATE TABLE shops (shop_id INT PRIMARY KEY, town_id INT REFERENCES towns(town_id), revenue DECIMAL(10,2));"""
GAMES = """CREATE TABLE players (player_id INT PRIMARY KEY, nickname TEXT);
    CREATE TABLE games (game_id INT PRIMARY KEY, player_id INT, points INT, played DATE);"""
APART = "CREATE TABLE pens (ink TEXT, price INT); CREATE TABLE cups (clay TEXT, volume INT)"

# definitions, question, draft (None: no usable join key)
CASES = [
    # one table: top k, comparisons, filters
    (STAFF, "Show the 5 workers by wage", "SELECT worker_id, full_name, dept, wage, total_sales, began FROM workers ORDER BY wage DESC LIMIT 5"),
    (STAFF, "the 3 lowest workers by total sales", "SELECT worker_id, full_name, dept, wage, total_sales, began FROM workers ORDER BY total_sales ASC LIMIT 3"),
    (STAFF, "Find workers whose wage is at least 20.5", "SELECT worker_id, full_name, dept, wage, total_sales, began FROM workers WHERE wage >= 20.5 ORDER BY wage DESC"),
    (STAFF, "Find active workers in Logistics with wage under 90 in 2021 limit 4",
     "SELECT worker_id, full_name, dept, wage, total_sales, began FROM workers WHERE wage < 90 AND year(began) = 2021 AND status = 'active' AND dept = 'Logistics' ORDER BY wage DESC LIMIT 4"),
    # one table: totals
    (STAFF, "total wage per dept", "SELECT dept, SUM(wage) AS sum_wage FROM workers GROUP BY dept ORDER BY sum_wage DESC"),
    (STAFF, "average wage", "SELECT AVG(wage) AS avg_wage FROM workers"),
    (STAFF, "calculate sum of total_sales by dept for the top 2", "SELECT dept, SUM(total_sales) AS total_sales FROM workers GROUP BY dept ORDER BY total_sales DESC LIMIT 2"),
    # a column named like an aggregate word asks for no aggregate
    (SONGS, "Find top 10 songs by play count", "SELECT song_id, title, genre, play_count, rating, released FROM songs ORDER BY play_count DESC LIMIT 10"),
    (BILLS, "Find top 5 bills with total over 5000", "SELECT bill_id, payer_name, total, issued FROM bills WHERE total > 5000 ORDER BY total DESC LIMIT 5"),
    # a year is no limit, and a compared number is no year
    (SONGS, "songs of the 2024 season", "SELECT song_id, title, genre, play_count, rating, released FROM songs WHERE year(released) = 2024 ORDER BY play_count DESC"),
    (SONGS, "songs with play_count over 2000", "SELECT song_id, title, genre, play_count, rating, released FROM songs WHERE play_count > 2000 ORDER BY play_count DESC"),
    # no name, no numbers, everything
    (LABS, "samples with weight above 3", "SELECT code, weight FROM samples WHERE weight > 3 ORDER BY code DESC"),
    (TICKETS, "Show tickets", "SELECT ticket_id, subject, priority FROM tickets ORDER BY ticket_id DESC"),
    (TICKETS, "Show all data of tickets", "SELECT * FROM tickets ORDER BY ticket_id DESC"),
    (TICKETS, "how many tickets for each priority", "SELECT priority, COUNT(*) AS count_rows FROM tickets GROUP BY priority ORDER BY count_rows DESC"),
    # two tables
    (TEAMS, "Find top 7 players of squads in the Sales dept with score over 10",
     "SELECT players.player_id, players.nickname FROM players JOIN squads ON players.squad_id = squads.squad_id WHERE players.score > 10 AND squads.dept = 'Sales' ORDER BY players.score DESC LIMIT 7"),
    (TEAMS, "total score for each squad",
     "SELECT squads.squad_id, squads.squad_name, SUM(players.score) AS sum_score FROM squads JOIN players ON squads.squad_id = players.squad_id GROUP BY squads.squad_id, squads.squad_name ORDER BY sum_score DESC"),
    # a path over a table between
    (CHAIN, "Show the total revenue of regions",
     "SELECT regions.region_id, regions.region_name, SUM(shops.revenue) AS total_revenue FROM regions JOIN towns ON regions.region_id = towns.region_id JOIN shops ON towns.town_id = shops.town_id GROUP BY regions.region_id, regions.region_name ORDER BY total_revenue DESC"),
    # "how many" counts rows of the tables it names
    (STAFF, "how many workers per dept in 2020",
     "SELECT dept, COUNT(*) AS count_rows FROM workers WHERE year(began) = 2020 GROUP BY dept ORDER BY count_rows DESC"),
    (SHOP, "how many returns for each customer in 2022",
     "SELECT customers.customer_id, customers.name, COUNT(*) AS count_rows, COUNT(DISTINCT returns.return_id) AS count_distinct FROM customers JOIN orders ON customers.customer_id = orders.customer_id JOIN returns ON orders.order_id = returns.order_id WHERE year(customers.since) = 2022 GROUP BY customers.customer_id, customers.name ORDER BY count_rows DESC"),
    # no foreign key, but an equal id column
    (GAMES, "top 3 players by total points in games of 2020",
     "SELECT players.player_id, players.nickname, SUM(games.points) AS sum_points FROM players JOIN games ON players.player_id = games.player_id WHERE year(games.played) = 2020 GROUP BY players.player_id, players.nickname ORDER BY sum_points DESC LIMIT 3"),
    # spend among seven tables
    (SHOP, "Which top 5 customers had the largest total spend on completed orders of 2024 once discounts are off? Give the number of distinct orders; equal spend is ranked by town",
     "SELECT customers.customer_id, customers.name, SUM(order_items.quantity * order_items.unit_price * (1 - order_items.discount_percent / 100.0)) AS total_spend, COUNT(DISTINCT orders.order_id) AS distinct_orders FROM customers JOIN orders ON customers.customer_id = orders.customer_id JOIN order_items ON orders.order_id = order_items.order_id WHERE year(orders.order_date) = 2024 AND orders.status = 'completed' GROUP BY customers.customer_id, customers.name ORDER BY total_spend DESC LIMIT 5"),
    (SHOP, "total spent by customers on orders, ties broken by customer_id",
     "SELECT customers.customer_id, customers.name, SUM(order_items.quantity * order_items.unit_price) AS total_spend FROM customers JOIN orders ON customers.customer_id = orders.customer_id JOIN order_items ON orders.order_id = order_items.order_id GROUP BY customers.customer_id, customers.name ORDER BY total_spend DESC, customers.customer_id ASC"),
    (SHOP, "total spent by customers on orders; sort ties by name ascending",
     "SELECT customers.customer_id, customers.name, SUM(order_items.quantity * order_items.unit_price) AS total_spend FROM customers JOIN orders ON customers.customer_id = orders.customer_id JOIN order_items ON orders.order_id = order_items.order_id GROUP BY customers.customer_id, customers.name ORDER BY total_spend DESC, customers.name ASC"),
    (SHOP, "total spent by customers on orders; the same amount should be sorted by name desc",
     "SELECT customers.customer_id, customers.name, SUM(order_items.quantity * order_items.unit_price) AS total_spend FROM customers JOIN orders ON customers.customer_id = orders.customer_id JOIN order_items ON orders.order_id = order_items.order_id GROUP BY customers.customer_id, customers.name ORDER BY total_spend DESC, customers.name DESC"),
    # "never" questions
    (SHOP, "customers with pending orders in 2023 who never returned anything",
     "SELECT customers.customer_id, customers.name FROM customers JOIN orders ON customers.customer_id = orders.customer_id WHERE year(orders.order_date) = 2023 AND orders.status = 'pending' AND customers.customer_id NOT IN (SELECT orders.customer_id FROM orders JOIN returns ON orders.order_id = returns.order_id WHERE year(orders.order_date) = 2023 AND orders.status = 'pending')"),
    (TEAMS, "squads that never had players", "SELECT squads.squad_id, squads.squad_name FROM squads WHERE squads.squad_id NOT IN (SELECT players.squad_id FROM players)"),
    (TEAMS, "players that never had squads", "SELECT players.player_id, players.nickname FROM players WHERE players.squad_id NOT IN (SELECT squads.squad_id FROM squads)"),
    # tables without any key between them
    (APART, "total price of pens and cups", None),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, d, q) for i, (d, q, _) in enumerate(CASES)], "row_id long, ddl string, question string")


@pytest.fixture(scope="module")
def drafted(corpus):
    return {r.row_id: r for r in drafts.draft_sql(corpus.repartition(4)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_draft(drafted, i):
    ddl, question, sql = CASES[i]
    assert drafted[i].sql == sql
    assert drafted[i].problem == (None if sql else drafts.NO_PATH)


@pytest.mark.parametrize("i", [i for i, c in enumerate(CASES) if c[2]])
def test_draft_compiles(drafted, i):
    """The statement runs on empty tables (keys between tables are left out: only names matter)."""
    con = duckdb.connect()
    for statement in filter(str.strip, CASES[i][0].split(";")):
        con.execute(statement)
    assert con.execute(drafted[i].sql).description


def test_rows_without_tables(spark):
    df = spark.createDataFrame([(1, "", "what"), (2, None, "x"), (3, TICKETS, ""), (4, TICKETS, None)], "row_id long, ddl string, question string")
    got = {r.row_id: (r.shape, r.problem) for r in drafts.draft_sql(df).collect()}
    assert got == {1: (None, drafts.NO_TABLE), 2: (None, drafts.NO_TABLE), 3: ("listing", None), 4: ("listing", None)}


READINGS = [
    ("Show the 5 highest-paid workers", {"limit_n": 5, "status": None}),
    ("first 12 workers", {"limit_n": 12}),
    ("top 2000 workers", {"limit_n": 2000, "year": None}),
    ("workers of the 2024 season, the 3 best", {"limit_n": 3, "year": 2024}),
    ("8 cheapest workers", {"limit_n": 8, "order_desc": False}),
    ("workers with wage over 1999 in 2001", {"year": 2001}),
    ("unpaid workers", {"status": "unpaid"}),
    ("inactive workers", {"status": None}),
    ("canceled or paid workers", {"status": "canceled"}),
    ("workers with wage at least 3", {"order_desc": True}),
    ("the mean wage and the total", {"agg": "avg"}),
    ("revenue of workers", {"agg": "sum", "says_revenue": True}),
    ("total workers by wage", {"agg": None, "order_col": "wage"}),
    ("count the workers by dept", {"agg": "count", "group_col": "dept"}),
    ("how many workers", {"agg": "count", "wants_count": True}),
    ("top workers by total sales", {"agg": None, "order_col": "total_sales"}),
    ("person list per dept", {"wants_groups": True}),
    ("every person", {"wants_groups": True}),
    ("a person", {"wants_groups": False}),
    ("unique workers without any discount", {"wants_distinct": True, "wants_anti": True, "has_discount": True}),
    ("workers who haven't left", {"wants_anti": True}),
    ("give me all details of workers", {"select_all": True}),
    ("same wage should be sorted by full_name desc", {"tie_col": "full_name", "tie_dir": "desc"}),
    ("Find Top Workers in Oslo with MRR and Wage", {"value_words": ["Workers", "Oslo", "MRR"]}),
    ("", {"limit_n": None, "agg": None, "comparisons": [], "value_words": []}),
]


def test_readings(spark):
    df = spark.createDataFrame([(i, STAFF, q) for i, (q, _) in enumerate(READINGS)], "row_id long, ddl string, question string")
    got = {r.row_id: r.asDict() for r in features.question_features(df).drop("tables").collect()}
    for i, (question, want) in enumerate(READINGS):
        assert {k: got[i][k] for k in want} == want, question


COMPARED = [
    ("wage > 5 and wage under 9", [("wage", ">", "5"), ("wage", "<", "9")]),
    ("wage is greater than 5.25", [("wage", ">", "5.25")]),
    ("wage at most 7", [("wage", "<=", "7")]),
    ("total sales exceeding 10, wage fewer than 3", [("total_sales", ">", "10"), ("wage", "<", "3")]),
    ("total sales over 4 and wage over 6", [("wage", ">", "6"), ("total_sales", ">", "4")]),
    ("wage over 4 or wage above 6", [("wage", ">", "4")]),
    ("workers over 40", [("", ">", "40")]),
    ("workers at least 40 but below 50", [("", ">=", "40"), ("", "<", "50")]),
    ("turnover 500", []),
    ("wage over many", []),
]


def test_comparisons(spark):
    df = spark.createDataFrame([(i, STAFF, q) for i, (q, _) in enumerate(COMPARED)], "row_id long, ddl string, question string")
    got = {r.row_id: [(c.col, c.op, c.number) for c in r.comparisons] for r in features.question_features(df).collect()}
    for i, (question, want) in enumerate(COMPARED):
        assert got[i] == want, question


def test_resolve_numeric_looks_everywhere_first(spark):
    ddl = "CREATE TABLE a (a_id INT PRIMARY KEY, height INT); CREATE TABLE b (b_id INT PRIMARY KEY, net_weight INT, weight INT)"
    hints = ["weight", "net", "height", "", "nothing"]
    df = spark.createDataFrame([(i, ddl, "a b") for i in range(len(hints))], "row_id long, ddl string, question string")
    df = features.question_features(df).withColumn("hint", F.get(F.array(*map(F.lit, hints)), F.col("row_id").cast("int")))
    found = features.resolve_numeric(F.col("tables"), F.col("hint"))
    got = {r.hint: (r.f.table, r.f.name) for r in df.select("hint", found.alias("f")).collect()}
    assert got == {
        "weight": ("b", "weight"),
        "net": ("b", "net_weight"),
        "height": ("a", "height"),
        "": ("a", "height"),
        "nothing": ("a", "height"),
    }


def test_one_schema_for_most_questions(spark):
    """Rows are read one by one, so a schema that most of them share changes nothing."""
    rows = [(i, SHOP if i % 3 else SONGS, f"top {i + 1} customers by total spend") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, ddl string, question string")
    got = {r.row_id: r.limit_n for r in features.question_features(df).collect()}
    assert got == {i: i + 1 for i in range(300)}


def test_tables_and_phrases_are_whole_words(spark):
    asked = {1: "customers ordered by name", 2: "order by name the customers", 3: "orders of customers not interested in lamps", 4: "order items with quantity over 3"}
    df = spark.createDataFrame([(i, SHOP, q) for i, q in asked.items()], "row_id long, ddl string, question string")
    got = {r.row_id: r for r in features.question_features(df).collect()}
    assert got[1].tables_named == ["customers"] and got[2].tables_named == ["customers"]
    assert got[3].tables_named == ["customers", "lamps", "orders"] and not got[3].wants_anti
    assert "order_items" in got[4].tables_named


def test_parts_of_other_shapes_are_not_worked_out(spark):
    ddl = "CREATE TABLE customers (customer_id INT PRIMARY KEY, full_name TEXT); CREATE TABLE orders (order_id INT, customer_id INT REFERENCES customers(customer_id), placed DATE)"
    corpus = spark.createDataFrame([(1, ddl, "Show orders of customers in 2020"), (2, ddl, "customers that never placed orders")], "row_id int, ddl string, question string")
    shaped = features.with_shape(features.with_involved(features.question_features(corpus)))
    got = {r.row_id: (r.shape, r.who) for r in drafts._anti(shaped).selectExpr("row_id", "shape", "_who.key AS who").collect()}
    assert got == {1: ("join", None), 2: ("anti", "customers")}
