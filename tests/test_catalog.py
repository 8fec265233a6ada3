"""Table definitions, roles and join graphs."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from qloom.functions.ddl import top_level_items
from qloom.operators import catalog

DDL = """
CREATE TABLE IF NOT EXISTS shop."Members" (
  member_id INT PRIMARY KEY, full_name VARCHAR(80) DEFAULT 'a,b(', joined DATETIME, checkin_date DATE,
  unique_visitors INT, price DECIMAL(10,2), CHECK (f(1, g(2, 3)) > 3), meta JSON, spent INTERVAL
);
create table visits (visit_id bigint, member_id int, status char(1), amount numeric, `key` varchar(10),
  KEY idx (status), -- it's a note, with a comma
  /* and one, too */ PRIMARY KEY (visit_id, "member_id"),
  CONSTRAINT fk FOREIGN KEY (member_id) REFERENCES members(member_id), UNIQUE (status), INDEX i (amount));
CREATE TABLE lines (visit_id BIGINT REFERENCES visits(visit_id), line_no SMALLINT, qty INT)
CREATE TABLE refunds (refund_id INT PRIMARY KEY, visit_id BIGINT, why TEXT, other_id INT FOREIGN KEY REFERENCES nowhere(id))
"""


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [
        (1, DDL),
        (2, ""),
        (3, "no tables here"),
        (4, None),
        (5, "CREATE TABLE a (x INT); CREATE TABLE b (y INT); CREATE TABLE A (z TEXT)"),
    ]
    return catalog.parse(spark.createDataFrame(rows, "schema_id long, ddl string")).cache()


def test_items_at_every_depth(spark):
    bodies = ["a INT, b DECIMAL(10,2), CHECK (f(a, g(b, (c, d))), e), z INT", "", "one", "a,,b", "open (a, b"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [[i.strip() for i in r[0]] for r in df.select(top_level_items(F.col("body"))).collect()]
    assert got == [
        ["a INT", "b DECIMAL(10,2)", "CHECK (f(a, g(b, (c, d))), e)", "z INT"],
        [""],
        ["one"],
        ["a", "", "b"],
        ["open (a, b"],
    ]


def test_tables(parsed):
    got = [(r.schema_id, r.table_ord, r.table_key, r.table_name) for r in catalog.catalog_tables(parsed).collect()]
    assert sorted(got) == [
        (1, 0, "members", "Members"),
        (1, 1, "visits", "visits"),
        (1, 2, "lines", "lines"),
        (1, 3, "refunds", "refunds"),
        # defined twice: first place, last definition
        (5, 0, "a", "A"),
        (5, 1, "b", "b"),
    ]


def test_columns(parsed):
    got = {(r.schema_id, r.table_key, r.col_name): r for r in catalog.catalog_columns(parsed).collect()}
    names = lambda t: [r.col_name for r in sorted((r for k, r in got.items() if k[:2] == (1, t)), key=lambda r: r.col_ord)]
    assert names("members") == [
        "member_id", "full_name", "joined", "checkin_date", "unique_visitors", "price", "meta", "spent",
    ]
    assert names("visits") == ["visit_id", "member_id", "status", "amount", "key"]
    assert got[5, "a", "z"].dtype == "TEXT"
    price, amount = got[1, "members", "price"], got[1, "visits", "amount"]
    assert (price.precision, price.scale, amount.precision, amount.scale) == (10, 2, 10, 0)
    families = {n: got[1, "members", n].family for n in names("members")}
    assert families["joined"] == "date" and families["meta"] == "other" and families["spent"] == "other"
    assert got[1, "visits", "member_id"].fk_table == "members"
    assert got[1, "refunds", "other_id"].fk_column == "id"


def test_keys(parsed):
    got = {(r.table_key, r.col_name, r.kind) for r in catalog.catalog_keys(parsed).where("schema_id = 1").collect()}
    assert got == {
        ("members", "member_id", "primary"),
        ("visits", "visit_id", "primary"),
        ("visits", "member_id", "primary"),
        ("visits", "member_id", "foreign"),
        ("lines", "visit_id", "foreign"),
        ("refunds", "refund_id", "primary"),
        ("refunds", "other_id", "foreign"),
    }


def test_roles(parsed):
    got = catalog.column_roles(parsed).where("schema_id = 1").collect()
    by = {}
    for r in sorted(got, key=lambda r: r.role_ord):
        by.setdefault((r.table_key, r.role), []).append(r.col_name)
    assert by["members", "id"] == ["member_id"] and by["members", "name"] == ["full_name"]
    assert by["members", "numeric"] == ["unique_visitors", "price"]
    assert by["members", "date"] == ["joined", "checkin_date"]
    # no name column: the first other text takes its place
    assert by["visits", "name"] == ["key"] and by["visits", "category"] == ["status"]
    assert ("lines", "id") not in by and by["lines", "numeric"] == ["line_no", "qty"]
    assert ("refunds", "numeric") not in by


def test_unknown_target_is_flagged(parsed):
    edges = catalog.join_edges(parsed).where("schema_id = 1 AND kind = 'fk'")
    assert {r.to_table for r in edges.where("NOT to_known").collect()} == {"nowhere"}


def routes(spark, parsed, sources):
    starts = spark.createDataFrame(sources, "schema_id long, from_table string").groupBy("schema_id").agg(F.collect_list("from_table").alias("starts"))
    found = catalog.join_paths(parsed.join(starts, "schema_id"), F.col("starts"))
    out = {}
    for r in found.collect():
        out[r.schema_id, r.from_table, r.to_table] = [tuple(s) for s in r.steps]
        assert r.hops == len(r.steps)
    return out


def test_paths(spark, parsed):
    got = routes(spark, parsed, [(1, "members"), (1, "refunds"), (1, "members"), (5, "a")])
    assert got[1, "members", "lines"] == [
        ("members", "member_id", "visits", "member_id"),
        ("visits", "visit_id", "lines", "visit_id"),
    ]
    assert got[1, "refunds", "lines"] == [("refunds", "visit_id", "lines", "visit_id")]
    assert got[1, "members", "nowhere"][-1] == ("refunds", "other_id", "nowhere", "id")
    assert not any(k[0] == 5 for k in got)


def test_long_chains_are_searched_to_their_end(spark):
    n = 10
    ddl = ";".join(f"CREATE TABLE t{i} (id INT PRIMARY KEY" + (f", up INT REFERENCES t{i - 1}(id))" if i else ")") for i in range(n))
    got = routes(spark, catalog.parse(spark.createDataFrame([(1, ddl)], "schema_id long, ddl string")), [(1, "t0")])
    assert sorted(got) == [(1, "t0", f"t{i}") for i in range(1, n)]
    assert len(got[1, "t0", "t9"]) == 9


def queue_search(tables, start):
    """Breadth-first search with a queue over all pairwise edges, in declaration order."""
    order = list(tables)
    edges = {t: [] for t in tables}
    for t in order:
        for col, target in tables[t]["fk"]:
            edges[t].append((col, target, "id"))
            edges[target].append(("id", t, col))
    holders = {}
    for t in order:
        for c in tables[t]["shared"]:
            holders.setdefault(c, []).append(t)
    for t in order:
        for c in tables[t]["shared"]:
            if len(holders[c]) > 1:
                edges[t] += [(c, u, c) for u in holders[c] if u != t]
    paths, queue = {start: []}, deque([start])
    while queue:
        node = queue.popleft()
        for col, target, target_col in edges[node]:
            if target not in paths:
                paths[target] = paths[node] + [(node, col, target, target_col)]
                queue.append(target)
    return {t: p for t, p in paths.items() if t != start}


def test_paths_equal_queue_search(spark):
    rnd = random.Random(11)
    ddls, want, sources = [], {}, []
    for schema in range(60):
        names = [f"t{i}" for i in range(rnd.randrange(2, 8))]
        tables = {}
        for t in names:
            fk = [(f"{t}_ref{j}", rnd.choice(names)) for j in range(rnd.randrange(0, 3))]
            shared = sorted(rnd.sample(["p_id", "q_id", "r_id"], rnd.randrange(0, 2)))
            tables[t] = {"fk": fk, "shared": shared}
        body = lambda t: ", ".join(
            ["id INT PRIMARY KEY"]
            + [f"{c} INT REFERENCES {u}(id)" for c, u in tables[t]["fk"]]  # noqa: B023
            + [f"{c} INT" for c in tables[t]["shared"]]  # noqa: B023
        )
        ddls.append((schema, ";".join(f"CREATE TABLE {t} ({body(t)})" for t in names)))
        start = rnd.choice(names)
        sources.append((schema, start))
        for target, path in queue_search(tables, start).items():
            want[schema, start, target] = path
    parsed = catalog.parse(spark.createDataFrame(ddls, "schema_id long, ddl string"))
    assert routes(spark, parsed, sources) == want


def test_one_column_shared_by_many_tables_stays_linear(spark):
    n = 300
    ddl = ";".join(f"CREATE TABLE t{i} (x{i} INT, hub_id INT)" for i in range(n))
    parsed = catalog.parse(spark.createDataFrame([(1, ddl)], "schema_id long, ddl string"))
    assert catalog.join_edges(parsed).count() == n
    got = routes(spark, parsed, [(1, "t0")])
    assert len(got) == n - 1
    assert got[1, "t0", "t7"] == [("t0", "hub_id", "t7", "hub_id")]


FAMILIES = {"INT": "numeric", "BIGINT": "numeric", "DECIMAL(9,3)": "numeric", "REAL": "numeric", "DATE": "date", "TIMESTAMP": "date",
            "VARCHAR(30)": "text", "TEXT": "text", "BOOLEAN": "none", "UUID": "none", "JSON": "other", "GEOMETRY(2)": "other"}


def random_definition(rnd):
    """A list of tables and one of many ways to write them down."""
    tables, texts = [], []
    for t in range(rnd.randrange(1, 5)):
        cols = []
        for c in range(rnd.randrange(1, 7)):
            cols.append([f"c{t}_{c}" + rnd.choice(["", "_id", "_name", "x"]), rnd.choice(list(FAMILIES)), False, None])
        primary = rnd.choice(["none", "inline", "clause"])
        if primary == "inline":
            cols[0][2] = True
        clauses = []
        if primary == "clause":
            for col in rnd.sample(cols, min(2, len(cols))):
                col[2] = True
            names = [c[0] for c in cols if c[2]]
            clauses.append("PRIMARY  KEY (" + rnd.choice([", ", ","]).join(names) + ")")
        for col in cols:
            if tables and rnd.random() < 0.3:
                target = rnd.choice(tables)
                col[3] = (target[0], target[1][0][0])
        lines = []
        for name, dtype, pk, fk in cols:
            text = f"{rnd.choice(['', '`', chr(34)])}{name}"
            text += {"`": "`", '"': '"'}.get(text[0], "") + rnd.choice([" ", "  ", "\t"]) + rnd.choice([dtype, dtype.lower()])
            if pk and primary == "inline":
                text += rnd.choice([" PRIMARY KEY", " primary key", " NOT NULL PRIMARY KEY"])
            if fk and rnd.random() < 0.5:
                text += f" REFERENCES {fk[0]}({fk[1]})"
            elif fk:
                clauses.append(rnd.choice(["", "CONSTRAINT k "]) + f"FOREIGN KEY ({name}) REFERENCES {fk[0]} ({fk[1]})")
            else:
                text += rnd.choice(["", " NOT NULL", " DEFAULT 'a, (b'", " CHECK (f(1, 2) > 0)"])
            lines.append(text)
        lines += clauses + rnd.choice([[], ["UNIQUE (x, y)"], ["CHECK (a > (b + c(1, 2)))"], ["INDEX i (z)"]])
        head = rnd.choice(["CREATE TABLE ", "create  table if not exists ", "CREATE TABLE main."])
        name = f"T{t}"
        sep = rnd.choice([", ", ",\n  ", " , -- note, more\n"])
        tables.append((name, cols))
        texts.append(f"{head}{name} ({sep.join(lines)})")
    return tables, rnd.choice([";", ";\n\n", "\n"]).join(texts) + rnd.choice(["", ";"])


def test_definitions_written_in_many_ways(spark):
    rnd = random.Random(21)
    made = [random_definition(rnd) for _ in range(300)]
    df = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(made)], "schema_id long, ddl string")
    got = {}
    for r in catalog.catalog_columns(catalog.parse(df)).collect():
        got.setdefault((r.schema_id, r.table_key), []).append(r)
    for i, (tables, text) in enumerate(made):
        for name, cols in tables:
            read = sorted(got.pop((i, name.lower())), key=lambda r: r.col_ord)
            want = [(n, FAMILIES[d], pk, fk and fk[0], fk and fk[1]) for n, d, pk, fk in cols]
            assert [(r.col_name, r.family, r.is_pk, r.fk_table, r.fk_column) for r in read] == want, text
    assert not got


def test_quoted_temporary_and_several_column_keys(spark):
    ddl = """CREATE TEMPORARY TABLE "sales days" ("day no" INT, `shop id` INT, note VARCHAR(9) DEFAULT "x y", PRIMARY KEY ("day no", `shop id`));
        CREATE OR REPLACE TABLE visits ([visit no] INT PRIMARY KEY, d INT, s INT, CONSTRAINT fk FOREIGN KEY (d, s) REFERENCES "sales days"("day no", `shop id`))
        CREATE TEMP TABLE IF NOT EXISTS x (a INT)"""
    parsed = catalog.parse(spark.createDataFrame([(1, ddl)], "schema_id long, ddl string"))
    assert [r.table_name for r in catalog.catalog_tables(parsed).orderBy("table_ord").collect()] == ["sales days", "visits", "x"]
    cols = {(r.table_key, r.col_name): r for r in catalog.catalog_columns(parsed).collect()}
    assert cols["sales days", "day no"].dtype == "INT" and cols["sales days", "shop id"].is_pk and cols["sales days", "note"].dtype == "VARCHAR"
    assert cols["visits", "visit no"].is_pk
    assert [(cols["visits", c].fk_table, cols["visits", c].fk_column) for c in "ds"] == [("sales days", "day no"), ("sales days", "shop id")]
