"""Catalogs, question features and draft SQL over the corpus made from parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qloom.operators import catalog, drafts, features, resolve
from qloom.plans.part_corpus import (
    EDGES,
    PARTS,
    PATHS,
    ROLES,
    SETTINGS,
    SPEC_COLUMNS,
    part_corpus,
    sql_case,
    sql_template,
)
from qloom.plans.registry import query

KINDS = tuple(SETTINGS)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.parse(part_corpus(spark, sf), "row_id")


@query(
    "catalog_tables",
    f"""
    WITH {PARTS}, {SPEC_COLUMNS}
    SELECT DISTINCT schema_id, table_ord, table_key, table_key AS table_name FROM cols
    """,
)
def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.catalog_tables(parsed(spark, sf))


@query(
    "catalog_columns",
    f"""
    WITH {PARTS}, {SPEC_COLUMNS}
    SELECT schema_id, table_key, col_ord, col_name, dtype, "precision", "scale", family, is_pk, is_fk, fk_table, fk_column
    FROM cols
    """,
)
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.catalog_columns(parsed(spark, sf))


@query(
    "catalog_keys",
    f"""
    WITH {PARTS}, {SPEC_COLUMNS}
    SELECT schema_id, table_key, col_name, 'primary' AS kind, NULL AS fk_table, NULL AS fk_column FROM cols WHERE is_pk
    UNION ALL
    SELECT schema_id, table_key, col_name, 'foreign', fk_table, fk_column FROM cols WHERE is_fk
    """,
)
def catalog_keys(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.catalog_keys(parsed(spark, sf))


@query(
    "type_family_profile",
    f"""
    WITH {PARTS}, {SPEC_COLUMNS}
    SELECT family, dtype, CAST(count(*) AS BIGINT) AS n_columns FROM cols GROUP BY family, dtype
    """,
)
def type_family_profile(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.type_family_profile(parsed(spark, sf))


@query(
    "column_roles",
    f"""
    WITH {PARTS}, roles(p_type, table_key, role, role_ord, col_name) AS (VALUES {ROLES})
    SELECT row_id AS schema_id, table_key, role, CAST(role_ord AS INTEGER) AS role_ord,
           replace(col_name, '{{n}}', n) AS col_name
    FROM parts JOIN roles USING (p_type)
    """,
)
def column_roles(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.column_roles(parsed(spark, sf))


@query(
    "join_edges",
    f"""
    WITH {PARTS}, edges(p_type, edge_ord, from_table, from_col, to_table, to_col, kind) AS (VALUES {EDGES})
    SELECT row_id AS schema_id, CAST(edge_ord AS INTEGER) AS edge_ord, from_table, from_col, to_table, to_col, kind,
           true AS to_known
    FROM parts JOIN edges USING (p_type)
    """,
)
def join_edges(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.join_edges(parsed(spark, sf))


@query(
    "join_paths",
    f"""
    WITH {PARTS}, paths(p_type, from_table, to_table, hops, route) AS (VALUES {PATHS})
    SELECT row_id AS schema_id, from_table, to_table, CAST(hops AS INTEGER) AS hops, route FROM parts JOIN paths USING (p_type)
    """,
)
def join_paths(spark: SparkSession, sf: str) -> DataFrame:
    schemas = parsed(spark, sf)
    found = catalog.join_paths(schemas, F.array(F.col("tables")[0]["key"]))
    step = lambda s: F.concat(
        s["from_table"], F.lit("."), s["from_col"], F.lit(" = "), s["to_table"], F.lit("."), s["to_col"]
    )
    return found.select(
        "schema_id", "from_table", "to_table", "hops", F.array_join(F.transform("steps", step), ", ").alias("route")
    )


def read(spark: SparkSession, sf: str, *wanted: str) -> DataFrame:
    return features.question_features(part_corpus(spark, sf).select("row_id", "ddl", "question"), wanted or None)


def expected(**columns: str) -> str:
    listed = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"WITH {PARTS} SELECT row_id, {listed} FROM parts"


def case(default: str = "NULL", **by_kind: str) -> str:
    return sql_case({k: by_kind.get(k, default) for k in KINDS})


def joined(col: Column | str) -> Column:
    """An array as one text, for comparison."""
    return F.array_join(col, ",")


@query("feat_limit", expected(limit_n=case(ECONOMY="p_size", STANDARD="p_size", SMALL="p_size")))
def feat_limit(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "limit_n").select("row_id", "limit_n")


@query("feat_year", expected(year="p_size + 1980"))
def feat_year(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "year").select("row_id", "year")


@query("feat_status", expected(status=case(ECONOMY="s", MEDIUM="s")))
def feat_status(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "status").select("row_id", "status")


@query("feat_aggregate", expected(agg=case(ECONOMY="'sum'", PROMO="'avg'", LARGE="'sum'")))
def feat_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "agg").select("row_id", "agg")


@query(
    "feat_flags",
    expected(
        wants_distinct="p_type = 'ECONOMY'",
        wants_count="p_type = 'ECONOMY'",
        has_discount="p_type = 'ECONOMY'",
        select_all="false",
    ),
)
def feat_flags(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "wants_distinct", "wants_count", "has_discount", "select_all").select("row_id", "wants_distinct", "wants_count", "has_discount", "select_all")


@query("feat_anti", expected(wants_anti="p_type = 'MEDIUM'"))
def feat_anti(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "wants_anti").select("row_id", "wants_anti")


@query("feat_direction", expected(order_desc="p_type NOT IN ('PROMO', 'SMALL')"))
def feat_direction(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "order_desc").select("row_id", "order_desc")


@query(
    "feat_columns",
    expected(
        cols_named=case(
            "''",
            ECONOMY="'customer_id'",
            PROMO="'km_' || n",
            STANDARD="'pay_' || n || ',hired'",
            LARGE="'tier,mrr_' || n",
            SMALL="'play_count,rating_' || n",
        )
    ),
)
def feat_columns(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "cols_named").select("row_id", joined("cols_named").alias("cols_named"))


@query(
    "feat_tables",
    expected(
        tables_named=case(
            ECONOMY="'customers,orders'",
            MEDIUM="'customers,orders,returns'",
            PROMO="'depots'",
            STANDARD="'teams,employees'",
            LARGE="'plans'",
            SMALL="'songs'",
        )
    ),
)
def feat_tables(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "tables_named").select("row_id", joined("tables_named").alias("tables_named"))


@query(
    "feat_comparisons",
    f"""
    WITH {PARTS}
    SELECT row_id, CASE p_type WHEN 'STANDARD' THEN 'pay_' WHEN 'LARGE' THEN 'mrr_' ELSE 'rating_' END || n AS col,
           CASE p_type WHEN 'STANDARD' THEN '>' WHEN 'LARGE' THEN '>=' ELSE '<' END AS op,
           CASE WHEN p_type = 'SMALL' THEN p_size + 0.5 ELSE CAST(p_partkey + 100 AS DOUBLE) END AS value
    FROM parts WHERE p_type IN ('STANDARD', 'LARGE', 'SMALL')
    """,
)
def feat_comparisons(spark: SparkSession, sf: str) -> DataFrame:
    return (
        read(spark, sf, "comparisons")
        .select("row_id", F.explode("comparisons").alias("c"))
        .select("row_id", "c.col", "c.op", F.col("c.value").cast("double").alias("value"))
    )


@query("feat_values", expected(value_words=case("''", STANDARD="'Berlin'")))
def feat_values(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "value_words").select("row_id", joined("value_words").alias("value_words"))


@query("feat_tiebreak", expected(tie_col=case(ECONOMY="'customer_id'"), tie_dir=case(ECONOMY="'asc'")))
def feat_tiebreak(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "tie_col", "tie_dir").select("row_id", "tie_col", "tie_dir")


@query("feat_by_column", expected(order_col=case(SMALL="'play_count'"), group_col=case(LARGE="'tier'")))
def feat_by_column(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "order_col", "group_col").select("row_id", "order_col", "group_col")


def involved(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return features.with_involved(read(spark, sf, *features.INVOLVES, *more))


def keys(tables: Column | str) -> Column:
    return joined(F.transform(tables, lambda t: t["key"]))


@query(
    "involved_tables",
    expected(
        tables=case(
            ECONOMY="'customers,orders,order_items'",
            MEDIUM="'customers,orders,returns'",
            PROMO="'depots,trucks,trips'",
            STANDARD="'teams,employees'",
            LARGE="'plans'",
            SMALL="'songs'",
        )
    ),
)
def involved_tables(spark: SparkSession, sf: str) -> DataFrame:
    return involved(spark, sf).select("row_id", keys("involved").alias("tables"))


@query(
    "primary_table",
    expected(
        primary_table=case(
            ECONOMY="'customers'",
            MEDIUM="'customers'",
            PROMO="'depots'",
            STANDARD="'employees'",
            LARGE="'plans'",
            SMALL="'songs'",
        )
    ),
)
def primary_table(spark: SparkSession, sf: str) -> DataFrame:
    return involved(spark, sf).select("row_id", features.primary_table(F.col("involved"))["key"].alias("primary_table"))


@query(
    "resolve_numeric",
    f"""
    WITH {PARTS}
    SELECT row_id, CASE p_type WHEN 'STANDARD' THEN 'employees' WHEN 'LARGE' THEN 'plans' ELSE 'songs' END AS "table",
           CASE p_type WHEN 'STANDARD' THEN 'pay_' WHEN 'LARGE' THEN 'mrr_' ELSE 'rating_' END || n AS name
    FROM parts WHERE p_type IN ('STANDARD', 'LARGE', 'SMALL')
    """,
)
def resolve_numeric(spark: SparkSession, sf: str) -> DataFrame:
    found = F.transform("comparisons", lambda c: features.resolve_numeric(F.col("involved"), c["col"]))
    return involved(spark, sf).select("row_id", F.inline(found))


@query(
    "group_column",
    f"""
    WITH {PARTS} SELECT row_id, 'mrr_' || n AS measure, 'tier' AS group_col FROM parts WHERE p_type = 'LARGE'
    """,
)
def group_column(spark: SparkSession, sf: str) -> DataFrame:
    grouping = ("group_col", "group_words", "wants_groups", "spelled")
    shaped = features.with_shape(involved(spark, sf, *grouping)).where(F.col("shape") == "aggregate")
    table = F.col("involved")[0]
    measure = features.measure_column(table, F.col("spelled"))
    return shaped.select("row_id", measure.alias("measure"), features.group_column(table, measure).alias("group_col"))


SHAPES = case(
    ECONOMY="'spend'", MEDIUM="'anti'", PROMO="'join'", STANDARD="'join'", LARGE="'aggregate'", SMALL="'listing'"
)


@query(
    "shape_profile",
    f"WITH {PARTS} SELECT {SHAPES} AS shape, CAST(count(*) AS BIGINT) AS n_questions FROM parts GROUP BY 1",
)
def shape_profile(spark: SparkSession, sf: str) -> DataFrame:
    return features.shape_profile(features.with_shape(involved(spark, sf)))


@query(
    "sql_drafts",
    expected(
        shape=SHAPES, sql=sql_case({k: sql_template(s.draft) for k, s in SETTINGS.items()}), problem="CAST(NULL AS VARCHAR)"
    ),
)
def sql_drafts(spark: SparkSession, sf: str) -> DataFrame:
    return drafts.draft_sql(part_corpus(spark, sf))


def statements(spark: SparkSession, sf: str) -> DataFrame:
    """The expected drafts, some with an unknown column (every 7th part) or table (every 11th)."""
    sql = F.col("answer")
    sql = F.when(F.col("row_id") % 7 == 0, F.regexp_replace(sql, "^SELECT ", "SELECT ghost, ")).otherwise(sql)
    sql = F.when(F.col("row_id") % 11 == 0, F.regexp_replace(sql, r"^(.*?) FROM (\w+)", "$1 FROM phantom_$2")).otherwise(sql)
    return part_corpus(spark, sf).select("row_id", F.col("kind").alias("label"), "ddl", sql.alias("generated"))


NAMES = f"""
    WITH {PARTS}, marked AS (
      SELECT lower(p_type) AS label, p_partkey % 11 = 0 AS bad_table, p_partkey % 7 = 0 AND p_partkey % 11 <> 0 AS bad_column
      FROM parts)
"""


@query(
    "resolvability_rate",
    f"""
    {NAMES}
    SELECT label, CAST(count(*) AS BIGINT) AS n_statements,
           count(*) FILTER (WHERE NOT bad_table AND NOT bad_column) / CAST(count(*) AS DOUBLE) AS resolvability_rate
    FROM marked GROUP BY label
    """,
)
def resolvability_rate(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolvability(statements(spark, sf))


@query(
    "hallucination_rate",
    f"""
    {NAMES}
    SELECT label, CAST(count(*) AS BIGINT) AS n_statements,
           count(*) FILTER (WHERE bad_table OR bad_column) / CAST(count(*) AS DOUBLE) AS hallucination_rate,
           count(*) FILTER (WHERE bad_table) / CAST(count(*) AS DOUBLE) AS table_rate,
           count(*) FILTER (WHERE bad_column) / CAST(count(*) AS DOUBLE) AS column_rate
    FROM marked GROUP BY label
    """,
)
def hallucination_rate(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.hallucination(statements(spark, sf))
