"""Comparison of a Spark result with the rows DuckDB gives for the same tables."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    return normal([d[0] for d in cur.description], cur.fetchall())


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])
