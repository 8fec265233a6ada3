"""Names in statements against the definitions beside them."""

from qloom.operators import resolve

DDL = """CREATE TABLE head (id INT PRIMARY KEY, name TEXT, born DATE);
    CREATE TABLE "Management" (department_id INT, head_id INT, acting BOOLEAN)"""

# statement, unknown names
CASES = [
    ("SELECT name FROM head WHERE born > 1856", []),
    ("SELECT count(*) FROM HEAD", []),
    ("SELECT T1.name FROM head AS T1 JOIN management AS T2 ON T1.id = T2.head_id WHERE T2.acting = 'Yes, ghost.x'", []),
    ("SELECT t1.ghost FROM head t1", [("column", "ghost")]),
    ("SELECT ghost, name FROM head", [("column", "ghost")]),
    ("SELECT department_id FROM head", [("column", "department_id")]),
    ("SELECT name FROM heads", [("table", "heads")]),
    ("SELECT h.name FROM head h JOIN nowhere n ON h.id = n.id", [("table", "nowhere")]),
    ("SELECT x.name FROM head h", [("table", "x")]),
    ("SELECT name AS who, count(*) AS n FROM head GROUP BY name HAVING count(*) > 2 ORDER BY n DESC, who LIMIT 3", []),
    ("SELECT head.name FROM head, management WHERE head.id = management.head_id", []),
    ("SELECT name FROM head WHERE id NOT IN (SELECT head_id FROM management)", []),
    ("SELECT name FROM head WHERE id NOT IN (SELECT ghost_id FROM management)", [("column", "ghost_id")]),
    ("SELECT sub.n FROM (SELECT count(*) AS n FROM head) AS sub", []),
    ("SELECT `name` FROM \"head\" -- ghost\n WHERE born BETWEEN 1 AND 2 AND name IS NOT NULL", []),
    ("SELECT CASE WHEN born > 1 THEN 'a' ELSE name END FROM main.head", []),
    ("SELECT name, CAST(born AS int) FROM head WHERE born >= 1.5", []),
    ("WITH young AS (SELECT name FROM head WHERE born > 1) SELECT name FROM young", []),
    ("WITH a AS (SELECT id FROM head), b (k) AS (SELECT head_id FROM nowhere) SELECT a.id, b.k FROM a JOIN b ON a.id = b.k", [("table", "nowhere")]),
    ("SELECT name who, count(*) total FROM head GROUP BY name ORDER BY total, who", []),
    ("SELECT CASE WHEN born > 1 THEN 1 ELSE 0 END flag, name FROM head ORDER BY flag", []),
    ("SELECT DISTINCT ghost FROM head", [("column", "ghost")]),
    # fields, casts, literals and windows
    ("SELECT EXTRACT(YEAR FROM born) FROM head", []),
    ("SELECT EXTRACT(YEAR FROM ghost) FROM head", [("column", "ghost")]),
    ("SELECT born::date, name::varchar(5) FROM head WHERE born > DATE '2020-01-01' + INTERVAL '1' DAY", []),
    ("SELECT SUM(id) OVER (PARTITION BY name ORDER BY born ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS s FROM head", []),
    ("SELECT rank() OVER w FROM head WINDOW w AS (PARTITION BY ghost ORDER BY born DESC)", [("column", "ghost")]),
    ("SELECT CAST(ghost AS decimal(9, 2)) FROM head", [("column", "ghost")]),
    ("SELECT trim(both ' ' from name) FROM head", [("column", "both")]),
    # every SELECT has its own names, and those around it
    ("SELECT name FROM head WHERE id IN (SELECT t.head_id FROM management t) AND t.acting", [("table", "t")]),
    ("SELECT name FROM head WHERE EXISTS (SELECT 1 FROM management m WHERE m.head_id = head.id AND born > 1)", []),
    ("SELECT head_id FROM head WHERE id IN (SELECT head_id FROM management)", [("column", "head_id")]),
    ("SELECT h.name FROM head h WHERE h.id = (SELECT max(h.head_id) FROM management h)", []),
    ("SELECT (SELECT n.ghost FROM management n) FROM head", [("column", "ghost")]),
    ("SELECT name FROM head UNION ALL SELECT department_id FROM management ORDER BY name", []),
    ("SELECT name FROM head UNION SELECT name FROM management", [("column", "name")]),
    ("SELECT x.k FROM (SELECT id AS k FROM head) x JOIN management ON head_id = x.k", []),
    ("SELECT a.name FROM head a, (SELECT head_id FROM management) b WHERE a.id = b.head_id", []),
    ("WITH a AS (SELECT ghost FROM head), b AS (SELECT x FROM a) SELECT x FROM b", [("column", "ghost")]),
    ("WITH RECURSIVE r (k) AS (SELECT id FROM head UNION ALL SELECT k FROM r) SELECT k FROM r", []),
    ("SELECT name FROM (WITH a AS (SELECT name FROM head) SELECT name FROM a) s; SELECT a.name FROM a", [("table", "a")]),
    ("SELECT \"name\" FROM \"Head\" ORDER BY [born]", []),
    ("SELECT count(*) FILTER (WHERE born > 1) FROM head GROUP BY ROLLUP (name)", []),
    ("SELECT name FROM head)) WHERE ghost", [("column", "ghost")]),
    ("", []),
]


def test_unresolved_names(spark):
    rows = [(i, "m", DDL, s) for i, (s, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "row_id long, label string, ddl string, generated string")
    got = {r.row_id: [tuple(u) for u in r.unresolved] for r in resolve.with_unresolved(df).collect()}
    for i, (sql, want) in enumerate(CASES):
        assert got[i] == want, sql


def test_rates(spark):
    rows = [("a", DDL, "SELECT name FROM head"), ("a", DDL, "SELECT ghost FROM head"), ("a", DDL, "SELECT 1 FROM heads"),
            ("a", DDL, "SELECT id FROM head"), ("b", DDL, "SELECT name FROM head")]
    df = spark.createDataFrame(rows, "label string, ddl string, generated string")
    assert {r.label: r.resolvability_rate for r in resolve.resolvability(df).collect()} == {"a": 0.5, "b": 1.0}
    got = {r.label: (r.hallucination_rate, r.table_rate, r.column_rate) for r in resolve.hallucination(df).collect()}
    assert got == {"a": (0.5, 0.25, 0.25), "b": (0.0, 0.0, 0.0)}


def test_fold_copies_no_text():
    # its state is copied after each word, so texts in it would be copied as often as a statement has words
    assert not [f for f, kind in resolve._STATE.items() if "string" in kind]


def test_brackets_that_close_too_often_change_nothing(spark):
    ddl = "CREATE TABLE t (a INT, b INT)"
    df = spark.createDataFrame([("x", ") SELECT a ) , ghost FROM t ) ) AS u", ddl)], "label string, generated string, ddl string")
    assert [tuple(u) for u in resolve.with_unresolved(df).first().unresolved] == [("column", "ghost")]
