"""The jobs return the layouts that the package states."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qloom import schemas
from qloom.operators import catalog, drafts, evaluation, features, telemetry

DDL = "CREATE TABLE a (a_id INT PRIMARY KEY, name TEXT); CREATE TABLE b (a_id INT REFERENCES a(a_id), n DECIMAL(4,1))"


def results(spark):
    corpus = spark.createDataFrame([(1, DDL, "total n of a per name")], "row_id long, ddl string, question string")
    parsed = catalog.parse(corpus, "row_id")
    edges = catalog.join_edges(parsed)
    preds = spark.createDataFrame([(1, "m", "x", "x", 1.0)], schemas.PREDICTIONS)
    requests = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "v", "s", 1.0)], "ts timestamp, model_version string, sql string, elapsed_ms double"
    )
    return {
        "CATALOG_TABLES": catalog.catalog_tables(parsed),
        "CATALOG_COLUMNS": catalog.catalog_columns(parsed),
        "COLUMN_ROLES": catalog.column_roles(parsed),
        "JOIN_EDGES": edges,
        "JOIN_PATHS": catalog.join_paths(parsed, F.array(F.lit("a"))),
        "QUESTION_FEATURES": features.question_features(corpus).select("row_id", *features.FEATURES),
        "DRAFTS": drafts.draft_sql(corpus),
        "REPORT": evaluation.report(preds),
        "SERVING_LOG": telemetry.serving_log(requests),
    }


def plain(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema]


@pytest.fixture(scope="module")
def made(spark):
    return results(spark)


@pytest.mark.parametrize(
    "name",
    ["CATALOG_TABLES", "CATALOG_COLUMNS", "COLUMN_ROLES", "JOIN_EDGES", "JOIN_PATHS", "QUESTION_FEATURES", "DRAFTS", "REPORT", "SERVING_LOG"],
)
def test_layout(spark, made, name):
    want = T.StructType.fromDDL(getattr(schemas, name))
    assert plain(made[name].schema) == plain(want)
    assert made[name].count() > 0
