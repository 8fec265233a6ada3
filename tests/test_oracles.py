"""Every named query against the SQL that checks it."""

import pytest

import __spark_entry__ as entry
from tests import oracle

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    columns, rows = oracle.duck_rows(con, ORACLES[name])
    got_columns, got = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    assert got_columns == columns
    assert len(got) == len(rows)
    assert got == rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
