"""Reading of comparisons, years, status words and names by scope of the question, and drafts run on data."""

import random

import duckdb
import pytest

from pyspark.sql import functions as F

from qloom.operators import drafts, features, reading
from qloom.plans.shop_corpus import SHOP

READ = [
    # question, comparisons, years, status
    ("orders not shipped", [], [], ("shipped", True)),
    ("orders that aren't yet shipped", [], [], ("shipped", True)),
    ("shipped orders", [], [], ("shipped", False)),
    ("orders not over 50", [("", "<=", "50")], [], None),
    ("orders, not many, shipped", [], [], ("shipped", False)),
    ("orders placed before 2020", [], [("<", 2020)], None),
    ("orders after 2019 and before 2022", [], [(">", 2019), ("<", 2022)], None),
    ("orders since 2019", [], [(">=", 2019)], None),
    ("orders from 2019 to 2021", [], [(">=", 2019), ("<=", 2021)], None),
    ("orders between 2019 and 2021", [], [(">=", 2019), ("<=", 2021)], None),
    ("orders between customers in 2020", [], [("=", 2020)], None),
    ("orders from customers in 2020", [], [("=", 2020)], None),
    ("orders of 2020 or 2021", [], [("=", 2020), ("=", 2021)], None),
    ("orders not in 2020", [], [("<>", 2020)], None),
    ("top 2000 orders", [], [], None),
    ("total_amount between 100 and 200", [("total_amount", ">=", "100"), ("total_amount", "<=", "200")], [], None),
    ("total_amount between 1990 and 2010", [("total_amount", ">=", "1990"), ("total_amount", "<=", "2010")], [], None),
    ("orders over 1,000", [("", ">", "1000")], [], None),
    ("orders over $2,500,000.75", [("", ">", "2500000.75")], [], None),
    ("orders over $500", [("", ">", "500")], [], None),
    ("total_amount at least € 5", [("total_amount", ">=", "5")], [], None),
    ("total_amount >= 7 and minutes <= 9", [("total_amount", ">=", "7"), ("minutes", "<=", "9")], [], None),
    ("total_amount is no less than 4", [("total_amount", ">=", "4")], [], None),
    ("tickets over 5 minutes", [("minutes", ">", "5")], [], None),
    ("orders over 2000", [("", ">", "2000")], [], None),
    ("orders of 1,2 and 3", [], [], None),
    ("the 3rd order in 2020.", [], [("=", 2020)], None),
    ("", [], [], None),
]


def asked(spark, questions, ddl=SHOP):
    return spark.createDataFrame([(i, ddl, q) for i, q in enumerate(questions)], "row_id long, ddl string, question string")


def test_numbers_years_and_status(spark):
    got = {r.row_id: r for r in features.question_features(asked(spark, [q for q, *_ in READ])).collect()}
    for i, (question, compared, years, status) in enumerate(READ):
        r = got[i]
        assert [(c.col, c.op, c.number) for c in r.comparisons] == compared, question
        assert [(y.op, y.year) for y in r.years] == years, question
        assert ((r.status, r.status_not) if r.status else None) == status, question
        assert r.year == (years[0][1] if years else None), question


def test_first_word_of_a_sentence_is_no_value(spark):
    questions = ["How many orders? Which from Chile", "Chile orders of Peru", "Orders... Give Oslo. Then Bergen"]
    got = {r.row_id: r.value_words for r in features.question_features(asked(spark, questions)).collect()}
    assert got == {0: ["Chile"], 1: ["Peru"], 2: ["Oslo", "Bergen"]}


TREES = [
    ("average total_amount per country", ["customers", "orders"]),
    ("total refund per country", ["customers", "orders", "returns"]),
    ("refund and minutes of customers", ["customers", "orders", "returns", "tickets"]),
    ("Top 5 customers by total_amount in 2021", ["customers", "orders"]),
    ("customers", ["customers"]),
]


def test_smallest_subtree(spark):
    df = features.with_involved(features.question_features(asked(spark, [q for q, _ in TREES])))
    got = {r.row_id: [t.key for t in r.involved] for r in df.collect()}
    assert got == {i: want for i, (_, want) in enumerate(TREES)}


RING = """CREATE TABLE a (a_id INT PRIMARY KEY, b_id INT REFERENCES b(b_id), alpha INT);
    CREATE TABLE b (b_id INT PRIMARY KEY, c_id INT REFERENCES c(c_id), beta INT);
    CREATE TABLE c (c_id INT PRIMARY KEY, d_id INT REFERENCES d(d_id), gamma INT);
    CREATE TABLE d (d_id INT PRIMARY KEY, hub_id INT REFERENCES hub(hub_id), delta INT);
    CREATE TABLE hub (hub_id INT PRIMARY KEY, hub_name TEXT);
    CREATE TABLE x (x_id INT PRIMARY KEY, hub_id INT REFERENCES hub(hub_id), a_id INT REFERENCES a(a_id), xi INT);
    CREATE TABLE y (y_id INT PRIMARY KEY, hub_id INT REFERENCES hub(hub_id), upsilon INT);"""


def test_three_tables_meet_where_their_paths_are_least(spark):
    # a, y and d: from a over x and the hub to both is shorter than along b and c
    df = features.with_involved(features.question_features(asked(spark, ["alpha, upsilon and delta of each row of d"], RING)))
    (row,) = df.collect()
    assert [t.key for t in row.involved] == ["a", "d", "hub", "x", "y"] and len(row.tree) == 4


@pytest.fixture(scope="module")
def shop():
    rng = random.Random(4)
    con = duckdb.connect()
    for statement in SHOP.split(";"):
        if statement.strip():
            con.execute(statement.split(" REFERENCES ")[0] if False else statement)
    customers = [(c, f"n{c}", rng.choice(["Chile", "Peru", "Oman"])) for c in range(12)]
    orders = [(o, rng.randrange(10), f"{rng.randrange(2018, 2023)}-05-01", rng.randrange(100, 900), rng.choice(["shipped", "paid"])) for o in range(40)]
    returns = [(r, rng.randrange(40), rng.randrange(5, 60)) for r in range(30)]
    tickets = [(t, rng.randrange(12), rng.randrange(1, 30), f"{rng.randrange(2018, 2023)}-02-03") for t in range(35)]
    for name, rows in (("customers", customers), ("orders", orders), ("returns", returns), ("tickets", tickets)):
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con, customers, orders, returns, tickets


def by(rows, key, value, how):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(value(r))
    return {k: how(v) for k, v in out.items()}


def mean(v):
    return sum(v) / len(v)


def test_totals_over_two_detail_tables_are_right_on_data(spark, shop):
    con, customers, orders, returns, tickets = shop
    owner, country = {o[0]: o[1] for o in orders}, {c[0]: c[2] for c in customers}
    amount = by(orders, lambda o: o[1], lambda o: o[3], sum)
    minutes = by(tickets, lambda t: t[1], lambda t: t[2], sum)
    refund = by(returns, lambda r: owner[r[1]], lambda r: r[2], sum)
    in_2020 = {t[1] for t in tickets if t[3].startswith("2020")}
    per_customer = lambda *parts: {c[0]: tuple(p.get(c[0]) for p in parts) for c in customers}
    wants = {
        "total total_amount and total minutes per customer": (1, per_customer(amount, minutes)),
        "total total_amount, total refund and total minutes per customer": (1, per_customer(amount, refund, minutes)),
        "how many orders and tickets per customer": (1, per_customer(by(orders, lambda o: o[1], lambda o: 1, sum), by(tickets, lambda t: t[1], lambda t: 1, sum))),
        "average total_amount and average minutes per country": (
            0,
            {
                k: (by(orders, lambda o: country[o[1]], lambda o: o[3], mean).get(k), by(tickets, lambda t: country[t[1]], lambda t: t[2], mean).get(k))
                for k in set(country.values())
            },
        ),
        "total total_amount per customer with tickets opened in 2020": (1, {c: (v,) for c, v in amount.items() if c in in_2020}),
        "maximum refund per country": (0, {k: (v,) for k, v in by(returns, lambda r: country[owner[r[1]]], lambda r: r[2], max).items()}),
    }
    drafted = {r.row_id: r for r in drafts.draft_sql(asked(spark, list(wants))).collect()}
    for i, (question, (names, want)) in enumerate(wants.items()):
        assert drafted[i].problem is None, question
        got = {r[0]: tuple(None if v is None else float(v) for v in r[1 + names :]) for r in con.execute(drafted[i].sql).fetchall()}
        assert got == {k: tuple(None if x is None else pytest.approx(float(x)) for x in v) for k, v in want.items()}, (question, drafted[i].sql)


LEFT = [
    ("customers of 2020", "left out: year = 2020"),
    ("paid tickets", "left out: paid"),
    ("top 3 customers who never placed orders over 50", "left out: limit 3, > 50"),
    ("tickets of Chile", "left out: Chile"),
    ("tickets opened in 2020 with minutes over 5", None),
    ("orders of customers in Chile and Peru", "left out: Peru"),
]


def test_parts_that_are_left_out_are_named(spark):
    got = {r.row_id: r.problem for r in drafts.draft_sql(asked(spark, [q for q, _ in LEFT])).collect()}
    assert got == {i: want for i, (_, want) in enumerate(LEFT)}


def test_names_that_need_quotes_are_quoted(spark):
    ddl = 'CREATE TABLE "price list" ("unit price" DECIMAL(8,2), "list id" INT PRIMARY KEY, "a""b" TEXT, region TEXT)'
    (row,) = drafts.draft_sql(asked(spark, ["average unit price of price list by region"], ddl)).collect()
    con = duckdb.connect()
    con.execute(ddl)
    assert con.execute(row.sql).description and row.sql.startswith('SELECT region, AVG("unit price") AS avg_unit_price FROM "price list"')


def test_a_question_is_folded_once(spark):
    """Each field picked from the fold's result from outside would write the fold into the plan again."""
    read = reading.read_words(F.lower("question"), F.array(F.lit("pay")), features.STATUS_WORDS)
    df = asked(spark, ["x"]).select(read.alias("read")).select("read.found", "read.years", "read.statuses", "read.words")
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_words_left_by_comparisons(spark):
    """A comparison takes the word it is about, and an "is" before it."""
    cases = {
        "teams with pay over 5 and size is above 7 of berlin": "teams with and of berlin",
        "pay over 5 over 6 x": "x",
        "is over 5 x": "is x",
        "b between between 3 and 4 x": "and x",
        "a b > > 3 x": "a x",
        "not shipped orders in 2020, by tier": "not shipped orders in by tier",
    }
    df = asked(spark, list(cases))
    read = reading.read_words(F.col("question"), F.array(F.lit("pay")), features.STATUS_WORDS)
    got = {r.question: " ".join(r.read.words) for r in df.select("question", read.alias("read")).collect()}
    assert got == cases
