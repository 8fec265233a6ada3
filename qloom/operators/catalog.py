"""Catalogs and join graphs of a corpus of table definitions.

Input rows are (schema_id, ddl). Everything is read out of each row by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.ddl import with_tables
from qloom.functions.stages import settled


def parse(corpus: DataFrame, id_col: str = "schema_id") -> DataFrame:
    """(schema_id, tables) of a corpus."""
    return with_tables(corpus.select(F.col(id_col).alias("schema_id"), "ddl")).drop("ddl")


def catalog_tables(parsed: DataFrame) -> DataFrame:
    return parsed.select("schema_id", F.explode("tables").alias("t")).select(
        "schema_id",
        F.col("t.ord").alias("table_ord"),
        F.col("t.key").alias("table_key"),
        F.col("t.name").alias("table_name"),
    )


def catalog_columns(parsed: DataFrame) -> DataFrame:
    """One row per column with its type, family and keys."""
    cols = parsed.select("schema_id", F.explode("tables").alias("t")).select(
        "schema_id", F.col("t.key").alias("table_key"), F.explode("t.cols").alias("c")
    )
    plain = ("dtype", "precision", "scale", "family", "is_pk", "is_fk", "fk_table", "fk_column")
    return cols.select(
        "schema_id",
        "table_key",
        F.col("c.ord").alias("col_ord"),
        F.col("c.name").alias("col_name"),
        *[F.col(f"c.{f}").alias(f) for f in plain],
    )


def catalog_keys(parsed: DataFrame) -> DataFrame:
    """Primary- and foreign-key columns, one row per key a column takes part in."""
    cols = catalog_columns(parsed)
    kinds = F.filter(
        F.array(
            F.struct(F.lit("primary").alias("kind"), F.col("is_pk").alias("holds")),
            F.struct(F.lit("foreign").alias("kind"), F.col("is_fk").alias("holds")),
        ),
        lambda k: k["holds"],
    )
    foreign = F.col("kind") == "foreign"
    return cols.withColumn("kind", F.explode(F.transform(kinds, lambda k: k["kind"]))).select(
        "schema_id",
        "table_key",
        "col_name",
        "kind",
        F.when(foreign, F.col("fk_table")).alias("fk_table"),
        F.when(foreign, F.col("fk_column")).alias("fk_column"),
    )


def type_family_profile(parsed: DataFrame) -> DataFrame:
    return catalog_columns(parsed).groupBy("family", "dtype").agg(F.count(F.lit(1)).alias("n_columns"))


def column_roles(parsed: DataFrame) -> DataFrame:
    """Which columns serve as id, name, number, date, category or other text."""
    t = parsed.select("schema_id", F.explode("tables").alias("t"))

    def of(role: str, names: Column) -> Column:
        return F.transform(
            names, lambda n, i: F.struct(F.lit(role).alias("role"), i.alias("role_ord"), n.alias("col_name"))
        )

    single = [of(role, F.array_compact(F.array(f"t.{role}_col"))) for role in ("id", "name")]
    many = [of(role, F.col(f"t.{role}")) for role in ("numeric", "date", "category", "text")]
    return t.select("schema_id", F.col("t.key").alias("table_key"), F.inline(F.concat(*single, *many)))


def _edge(source: Column, source_col: Column, target: Column, target_col: Column, kind: str) -> Column:
    return F.struct(
        source.alias("from_table"),
        source_col.alias("from_col"),
        target.cast("string").alias("to_table"),
        target_col.alias("to_col"),
        F.lit(kind).alias("kind"),
    )


def with_edges(df: DataFrame) -> DataFrame:
    """Add ``edges``: the join graph of ``tables`` in declaration order, as ``join_edges`` lists it."""

    def id_keys(t: Column) -> Column:
        return F.transform(F.filter(t["cols"], lambda c: F.endswith(c["key"], F.lit("_id"))), lambda c: c["key"])

    staged = df.withColumn(
        "_ids", F.sort_array(F.flatten(F.transform("tables", lambda t: F.array_distinct(id_keys(t)))))
    ).withColumn(
        "_shared", F.array_distinct(F.filter("_ids", lambda k, i: (i > 0) & (k == F.get(F.col("_ids"), i - 1))))
    )

    def foreign(t: Column) -> Column:
        return F.flatten(
            F.transform(
                F.filter(t["cols"], lambda c: c["is_fk"]),
                lambda c: F.array(
                    _edge(t["key"], c["name"], F.lower(c["fk_table"]), c["fk_column"], "fk"),
                    _edge(F.lower(c["fk_table"]), c["fk_column"], t["key"], c["name"], "fk"),
                ),
            )
        )

    def shared(t: Column) -> Column:
        return F.transform(
            F.filter(t["cols"], lambda c: F.array_contains(F.col("_shared"), c["key"])),
            lambda c: _edge(t["key"], c["name"], F.lit(None), c["key"], "shared"),
        )

    edges = F.concat(
        F.flatten(F.transform("tables", foreign)),
        F.flatten(F.transform("tables", shared)),
    )
    return staged.withColumn("edges", edges).drop("_ids", "_shared")


def join_edges(parsed: DataFrame) -> DataFrame:
    """Edges of the join graph in declaration order.

    A foreign key gives an edge each way. Tables with an equal id column all join each other; listing
    these pairs grows with the square of the tables, so each table is given one 'shared' edge to the
    column name as meeting point (``to_table`` null, ``to_col`` the name). ``to_known`` is false where
    a foreign key names a table that the definitions lack.
    """
    known = F.transform("tables", lambda t: t["key"])
    return (
        settled(with_edges(parsed), "edges", "tables")
        .select("schema_id", known.alias("_known"), F.posexplode("edges").alias("edge_ord", "e"))
        .select("schema_id", "edge_ord", "e.*", "_known")
        .withColumn("to_known", F.col("to_table").isNull() | F.array_contains("_known", F.col("to_table")))
        .drop("_known")
    )


_STEP = ("from_table", "from_col", "to_table", "to_col")
_STEPS = "array<struct<" + ",".join(f"{f}:string" for f in _STEP) + ">>"


def _neighbours(edges: Column, node: Column) -> Column:
    """(to_table, from_col, to_col) of the edges that leave a table, in declaration order; shared columns lead to all their holders."""

    def to(target: Column, own: Column, theirs: Column) -> Column:
        return F.struct(target.alias("to_table"), own.alias("from_col"), theirs.alias("to_col"))

    def leads(e: Column) -> Column:
        holders = F.filter(
            edges, lambda m: (m["kind"] == "shared") & (m["to_col"] == e["to_col"]) & (m["from_table"] != node)
        )
        return F.when(e["kind"] == "fk", F.array(to(e["to_table"], e["from_col"], e["to_col"]))).otherwise(
            F.transform(holders, lambda m: to(m["from_table"], e["from_col"], m["from_col"]))
        )

    return F.flatten(F.transform(F.filter(edges, lambda e: e["from_table"] == node), leads))


def paths_from(edges: Column, source: Column) -> Column:
    """Shortest join paths from a table, as an array of (to_table, steps) that starts with the table itself.

    A breadth-first search inside the row: the array is the queue, and each round of the fold lets one
    entry of it add the neighbours not met before. There are as many rounds as tables that have edges.
    Of several paths with the fewest steps, the one whose edges were declared first is kept.
    """
    start = F.array(F.struct(source.alias("to_table"), F.array().cast(_STEPS).alias("steps")))
    nodes = F.size(F.array_distinct(F.transform(edges, lambda e: e["from_table"])))
    rounds = F.sequence(F.lit(0), nodes)

    def visit(queue: Column, at: Column) -> Column:
        new = F.filter(
            _neighbours(edges, at["to_table"]), lambda n: ~F.exists(queue, lambda q: q["to_table"] == n["to_table"])
        )
        # the one-element array names the new entries, so that they are found once
        once = F.flatten(
            F.transform(
                F.array(new),
                lambda ns: F.filter(
                    ns, lambda n, k: ~F.exists(F.slice(ns, F.lit(1), k), lambda p: p["to_table"] == n["to_table"])
                ),
            )
        )

        def reached(n: Column) -> Column:
            values = (at["to_table"], n["from_col"], n["to_table"], n["to_col"])
            step = F.struct(*[v.alias(f) for v, f in zip(values, _STEP)])
            return F.struct(n["to_table"].alias("to_table"), F.concat(at["steps"], F.array(step)).alias("steps"))

        return F.concat(queue, F.transform(once, reached))

    def round_of(queue: Column, k: Column) -> Column:
        # once all tables are met there is nothing to add
        open_ = (k < F.size(queue)) & (F.size(queue) < F.greatest(nodes, F.lit(2)))
        return F.when(open_, visit(queue, F.get(queue, k))).otherwise(queue)

    return F.aggregate(rounds, start, round_of)


def known_edges() -> Column:
    """The edges of a row whose two tables are among its definitions."""
    return F.filter("edges", lambda e: (e["kind"] == "shared") | F.exists("tables", lambda t: t["key"] == e["to_table"]))


def join_tree(edges: Column, keys: Column, wanted: Column) -> Column:
    """The smallest connected part of the join graph that holds all wanted tables, as steps away from one of its tables; null if there is none.

    Two tables are joined by the shortest path between them. For more, each table in turn is tried as the place where shortest
    paths to all of them meet, and the meeting place whose paths have the fewest different steps is taken, which is
    least possible for three tables, and for any number where the graph has no cycles.
    """
    steps = lambda paths: F.array_distinct(F.flatten(F.transform(paths, lambda p: p["steps"])))

    def meeting(at: Column) -> Column:
        # the one-element array names the paths, so that they are searched once
        return F.flatten(
            F.transform(
                F.array(F.filter(paths_from(edges, at), lambda p: F.array_contains(wanted, p["to_table"]))),
                lambda ps: F.when(F.size(ps) == F.size(wanted), F.array(steps(ps))).otherwise(F.array().cast(f"array<{_STEPS}>")),
            )
        )

    places = F.when(F.size(wanted) <= 2, F.slice(wanted, 1, 1)).otherwise(F.array_union(wanted, keys))
    found = F.flatten(F.transform(places, meeting))
    least = F.array_min(F.transform(found, lambda s, i: F.struct(F.size(s).alias("size"), i.alias("place"))))
    return F.get(found, least["place"])


def join_paths(parsed: DataFrame, sources: Column) -> DataFrame:
    """Shortest join path from each source to every table it reaches, of any length.

    ``sources`` is an array of table keys out of the columns of a row.
    """
    graph = settled(with_edges(parsed.withColumn("_sources", F.array_distinct(sources))), "edges")
    searched = graph.select("schema_id", "edges", F.explode("_sources").alias("from_table"))
    found = searched.select(
        "schema_id", "from_table", F.inline(F.slice(paths_from(F.col("edges"), F.col("from_table")), 2, 2**31 - 2))
    )
    return found.select("schema_id", "from_table", "to_table", F.size("steps").alias("hops"), "steps")
