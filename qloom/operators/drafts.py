"""Draft SQL for questions about tables, as weak labels for a corpus.

The drafts are text put together from the catalog and feature columns of each row; join paths are
searched inside the row too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.ddl import any_of, first, last
from qloom.functions.stages import settled
from qloom.operators import catalog
from qloom.operators.features import (
    ANTI_PHRASES,
    SPEND_TABLES,
    group_column,
    measure_column,
    primary_table,
    question_features,
    resolve_numeric,
    with_involved,
    with_shape,
)

# Words that name the parts of a "never" question, and columns a value may filter.
NEGATIVE_WORDS = ("return", "refund", "cancel", "complain")
POSITIVE_WORDS = ("customer", "user", "employee", "student", "patient", "player")
JOINED_CATEGORY_WORDS = (
    "category", "dept", "department", "country", "type", "status", "tier", "specialty", "genre", "course",
)
# End of fixed values.

# Feature columns that drafts over several tables are made of.
_JOIN_INPUT = (
    "tables", "involved", "asked", "edges", "tree", "agg", "agg_stated", "comparisons", "measures", "says_revenue", "years", "status",
    "status_not", "value_words", "limit_n", "tie_col", "tie_dir", "wants_count", "select_all", "order_col", "order_desc", "group_col",
    "group_words", "cols_named", "text_order",
)

NO_PATH = "no join path"
NO_TABLE = "no table"
LEFT_OUT = "left out: "


def _text(*parts) -> Column:
    """Concatenation; null if any part is null."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _clause(word: str, *parts: Column, sep: str = ", ") -> Column:
    """``" WORD a, b"`` out of the parts that are not null, or nothing."""
    body = F.concat_ws(sep, *parts)
    return F.when(body != "", _text(f" {word} ", body)).otherwise("")


def _limit() -> Column:
    return F.coalesce(_text(" LIMIT ", F.col("limit_n").cast("string")), F.lit(""))


def _direction(descending: Column) -> Column:
    return F.when(descending, " DESC").otherwise(" ASC")


def _equals(col: Column, value: Column, negated: Column | None = None) -> Column:
    sign = F.lit(" = '") if negated is None else F.when(negated, " <> '").otherwise(" = '")
    return _text(col, sign, value, "'")


def _has_status(col: Column) -> Column:
    return _equals(col, F.col("status"), F.col("status_not"))


def _in_year(col: Column) -> Column:
    """The bounds of the years asked for; several plain years are alternatives. Null without a year or a column."""
    plain = F.filter("years", lambda y: y["op"] == "=")
    single = lambda y: _text("year(", col, ") ", y["op"], " ", y["year"].cast("string"))
    several = _text("year(", col, ") IN (", F.array_join(F.transform(plain, lambda y: y["year"].cast("string")), ", "), ")")
    rest = F.transform(F.filter("years", lambda y: (y["op"] != "=") | (F.size(plain) == 1)), single)
    parts = F.concat(rest, F.when(F.size(plain) > 1, F.array(several)).otherwise(F.array().cast("array<string>")))
    return F.when(col.isNotNull() & (F.size("years") > 0), F.array_join(parts, " AND "))


def _named(table: Column, part: str) -> Column:
    return first(F.filter(table["cols"], lambda c: F.contains(c["key"], F.lit(part))))["name"]


def _qualified(table: Column, col: Column) -> Column:
    return _text(table["name"], ".", col)


def _comparisons(tables: Column, qualify: bool) -> Column:
    """All comparisons, with their columns resolved, joined by AND (null if there is none)."""

    def one(c: Column) -> Column:
        found = resolve_numeric(tables, c["col"])
        name = _text(found["table"], ".", found["name"]) if qualify else found["name"]
        return _text(name, " ", c["op"], " ", c["number"])

    return F.nullif(F.concat_ws(" AND ", F.transform("comparisons", one)), F.lit(""))


def _alias(measure: Column) -> Column:
    measure = F.regexp_replace(measure, r"\W", "_")
    return (
        F.when(F.col("says_revenue"), "total_revenue")
        .when(F.startswith(F.lower(measure), F.lit("total_")), F.lower(measure))
        .otherwise(_text(F.col("agg"), "_", measure))
    )


def _total(col: Column) -> Column:
    return _text(F.upper(F.col("agg")), "(", col, ")")


def _single_where(t: Column) -> Column:
    return _clause(
        "WHERE",
        _comparisons(F.col("involved"), qualify=False),
        _in_year(first(t["date"])),
        _has_status(_named(t, "status")),
        _equals(first(t["category"]), first(F.col("value_words"))),
        sep=" AND ",
    )


def _listing(t: Column) -> Column:
    chosen = F.array_distinct(
        F.array_compact(
            F.concat(
                F.array(t["id_col"], t["name_col"]),
                F.slice(t["category"], 1, 1),
                F.slice(t["numeric"], 1, 2),
                F.slice(t["date"], 1, 1),
            )
        )
    )
    head = F.transform(F.slice(t["cols"], 1, 5), lambda c: c["name"])
    columns = F.when(F.col("select_all"), F.array(F.lit("*"))).when(F.size(chosen) > 0, chosen).otherwise(head)
    hinted = first(F.filter(t["cols"], lambda c: c["name"] == F.col("order_col")))["name"]
    worded = first(F.filter(t["cols"], lambda c: c["name"] == F.col("text_order")))["name"]
    lead = F.coalesce(hinted, first(t["numeric"]))
    order = F.coalesce(_text(worded, " ASC"), _text(lead, _direction(F.col("order_desc"))), _text(t["id_col"], " DESC"))
    return _text(
        "SELECT ", F.array_join(columns, ", "), " FROM ", t["name"], _single_where(t), _clause("ORDER BY", order), _limit()
    )


def _aggregate(t: Column) -> Column:
    measure = F.when(F.col("agg_stated"), measure_column(t, F.col("spelled")))
    group = group_column(t, measure)
    total = F.coalesce(_total(measure), F.lit("COUNT(*)"))
    alias = F.coalesce(_alias(measure), F.lit("count_rows"))
    return _text(
        "SELECT ",
        F.concat_ws(", ", group, _text(total, " AS ", alias)),
        " FROM ",
        t["name"],
        _single_where(t),
        _clause("GROUP BY", group),
        F.when(group.isNotNull(), _text(" ORDER BY ", alias, " DESC")).otherwise(""),
        _limit(),
    )


def _key_between(a: Column, b: Column) -> Column:
    """Join key of two tables as struct(left, right): an equal id column, else a foreign key either way."""
    right_keys = F.transform(b["cols"], lambda c: c["key"])
    shared = first(
        F.filter(a["cols"], lambda c: F.endswith(c["key"], F.lit("_id")) & F.array_contains(right_keys, c["key"]))
    )
    twin = first(F.filter(b["cols"], lambda c: c["key"] == shared["key"]))
    forward = first(F.filter(a["cols"], lambda c: F.lower(c["fk_table"]) == b["key"]))
    backward = first(F.filter(b["cols"], lambda c: F.lower(c["fk_table"]) == a["key"]))

    def pair(left: Column, right: Column) -> Column:
        return F.when(left.isNotNull() & right.isNotNull(), F.struct(left.alias("left"), right.alias("right")))

    return F.coalesce(
        pair(shared["name"], twin["name"]),
        pair(forward["name"], forward["fk_column"]),
        pair(backward["fk_column"], backward["name"]),
    )


def _join(a: Column, b: Column, key: Column) -> Column:
    return _text(" JOIN ", b["name"], " ON ", _qualified(a, key["left"]), " = ", _qualified(b, key["right"]))


def _anti(df: DataFrame) -> DataFrame:
    """Columns for "never" questions: who, through which table, and who is ruled out."""
    negative = lambda t: any_of(t["key"], NEGATIVE_WORDS)
    order = lambda t: F.contains(t["key"], F.lit("order")) & ~F.contains(t["key"], F.lit("item"))
    bridge = lambda t: ~negative(t) & order(t)
    positive = lambda t: ~negative(t) & ~bridge(t) & any_of(t["key"], POSITIVE_WORDS)
    # the columns are used more than once, so that Spark works them out for all rows: other questions have no tables here
    tables = F.when(F.col("shape") == "anti", F.col("involved"))
    # the entity stands before the "never": "teams that never won a game" lists teams
    lead = F.regexp_extract("said", "^(.*?)(?:" + "|".join(ANTI_PHRASES) + ")", 1)
    before = lambda t: F.regexp_like(
        lead, F.concat(F.lit(r"\b"), F.regexp_replace(t["key"], "s+$", ""), F.lit(r"s*\b"))
    )
    entity = lambda t: ~negative(t) & before(t)
    df = df.withColumn(
        "_who",
        F.coalesce(
            first(F.filter(tables, lambda t: entity(t) & ~bridge(t))),
            last(F.filter(tables, positive)),
            first(F.filter(tables, entity)),
            first(tables),
        ),
    )
    df = df.withColumn("_via", last(F.filter(tables, lambda t: bridge(t) & (t["key"] != F.col("_who.key")))))
    others = F.filter(tables, lambda t: t["key"] != F.col("_who.key"))
    df = df.withColumn("_not", F.coalesce(last(F.filter(tables, negative)), last(others)))
    who, via, ruled_out = F.col("_who"), F.col("_via"), F.col("_not")
    df = df.withColumns(
        {
            "_who_via": _key_between(who, via),
            "_via_not": _key_between(via, ruled_out),
            "_who_not": _key_between(who, ruled_out),
        }
    )
    wanted = F.concat_ws(
        " AND ",
        _in_year(_qualified(via, first(via["date"]))),
        _has_status(_qualified(via, _named(via, "status"))),
    )
    shown = F.concat_ws(", ", _qualified(who, who["id_col"]), _qualified(who, who["name_col"]))
    columns = F.when(shown != "", shown).otherwise(_text(who["name"], ".*"))

    def ruled(key: Column, negatives: Column) -> Column:
        # the same key on both sides, which need not be the entity's own id
        return _text(_qualified(who, key["left"]), " NOT IN (", negatives, ")")

    through = _text(
        "SELECT ",
        _qualified(via, F.col("_who_via")["right"]),
        " FROM ",
        via["name"],
        _join(via, ruled_out, F.col("_via_not")),
        F.when(wanted != "", _text(" WHERE ", wanted)).otherwise(""),
    )
    bridged = _text(
        "SELECT ",
        columns,
        " FROM ",
        who["name"],
        _join(who, via, F.col("_who_via")),
        _clause("WHERE", F.nullif(wanted, F.lit("")), ruled(F.col("_who_via"), through), sep=" AND "),
    )
    direct = _text(
        "SELECT ",
        columns,
        " FROM ",
        who["name"],
        " WHERE ",
        ruled(
            F.col("_who_not"),
            _text("SELECT ", _qualified(ruled_out, F.col("_who_not")["right"]), " FROM ", ruled_out["name"]),
        ),
    )
    return df.withColumn("_anti_sql", F.when(via.isNotNull(), bridged).otherwise(direct))


def _spend(df: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """Columns for spend questions over customers, orders and their items."""

    def table(name: str) -> Column:
        return first(F.filter(F.when(F.col("shape") == "spend", F.col("involved")), lambda t: t["key"] == name))

    df = df.withColumns({"_customers": table(names[0]), "_orders": table(names[1]), "_items": table(names[2])})
    customers, orders, items = F.col("_customers"), F.col("_orders"), F.col("_items")
    df = df.withColumns({"_co": _key_between(customers, orders), "_oi": _key_between(orders, items)})

    def item(col: Column) -> Column:
        return _qualified(items, col)

    quantity = F.coalesce(_named(items, "quantity"), _named(items, "qty"))
    unit_price = first(
        F.filter(items["cols"], lambda c: F.contains(c["key"], F.lit("price")) & F.contains(c["key"], F.lit("unit")))
    )["name"]
    price = F.coalesce(unit_price, _named(items, "price"))
    amount = _text(item(quantity), " * ", item(price))
    discounted = F.when(
        F.col("has_discount"), _text(amount, " * (1 - ", item(_named(items, "discount")), " / 100.0)")
    )
    measure = F.coalesce(
        _text("SUM(", F.coalesce(discounted, amount), ")"),
        _text("SUM(", item(first(items["numeric"])), ")"),
        F.lit("COUNT(*)"),
    )
    who = F.concat_ws(
        ", ",
        _qualified(customers, F.coalesce(customers["id_col"], F.col("_co")["left"])),
        _qualified(customers, customers["name_col"]),
    )
    orders_counted = F.when(
        F.col("wants_count") | F.col("wants_distinct"),
        _text("COUNT(DISTINCT ", _qualified(orders, orders["id_col"]), ") AS distinct_orders"),
    )
    sql = _text(
        "SELECT ",
        F.concat_ws(", ", who, _text(measure, " AS total_spend"), orders_counted),
        " FROM ",
        customers["name"],
        _join(customers, orders, F.col("_co")),
        _join(orders, items, F.col("_oi")),
        _clause(
            "WHERE",
            _in_year(_qualified(orders, first(orders["date"]))),
            _has_status(_qualified(orders, _named(orders, "status"))),
            sep=" AND ",
        ),
        " GROUP BY ",
        who,
        " ORDER BY total_spend DESC",
        _tie(customers),
        _limit(),
    )
    return df.withColumn("_spend_sql", sql)


def _tie(primary: Column) -> Column:
    """Second sort key: the column and direction the question asks for, on the entity it lists; its id needs no direction."""
    asked = F.filter(
        F.array_compact(F.array(primary["name_col"], primary["id_col"])), lambda n: F.lower(n) == F.col("tie_col")
    )
    col = F.coalesce(first(asked), primary["id_col"])
    stated = _text(", ", _qualified(primary, col), " ", F.upper(F.col("tie_dir")))
    by_id = F.when(F.col("tie_col") == F.lower(primary["id_col"]), _text(", ", _qualified(primary, primary["id_col"]), " ASC"))
    return F.coalesce(F.when(F.col("tie_col").isNotNull(), stated), by_id, F.lit(""))


def _with_paths(df: DataFrame) -> DataFrame:
    """Add ``paths`` (to_table, steps) from the primary table to all other involved ones, nearer ones first, and their ``steps``; null where one cannot be reached."""
    both_ways = F.flatten(
        F.transform(
            "tree",
            lambda e: F.array(
                F.struct(*[e[f].alias(f) for f in ("from_table", "from_col", "to_table", "to_col")], F.lit("fk").alias("kind")),
                F.struct(
                    e["to_table"].alias("from_table"), e["to_col"].alias("from_col"), e["from_table"].alias("to_table"),
                    e["from_col"].alias("to_col"), F.lit("fk").alias("kind"),
                ),
            ),
        )
    )
    df = settled(df.withColumn("_graph", F.coalesce(both_ways, catalog.known_edges())), "_graph", "_primary", "_others", "involved")
    found = F.filter(
        catalog.paths_from(F.col("_graph"), F.col("_primary.key")),
        lambda p: F.exists("_others", lambda t: t["key"] == p["to_table"]),
    )
    # the steps with the names as declared, found once
    spelled = lambda x: F.struct(
        *[x[f].alias(f) for f in ("from_table", "from_col", "to_table", "to_col")], _declared(x["from_table"]).alias("from_name"), _declared(x["to_table"]).alias("to_name")
    )
    found = F.transform(found, lambda p: F.struct(p["to_table"].alias("to_table"), F.transform(p["steps"], spelled).alias("steps")))
    df = settled(df.withColumn("paths", found), "paths")
    steps = F.array_distinct(F.flatten(F.transform("paths", lambda p: p["steps"])))
    reached = F.size("paths") == F.size("_others")
    return df.withColumn("steps", F.when(reached, steps)).drop("edges", "tree", "_graph")


def _declared(key: Column) -> Column:
    return first(F.filter("tables", lambda t: t["key"] == key))["name"]


def _step_text(s: Column) -> Column:
    return _text(" JOIN ", s["to_name"], " ON ", s["from_name"], ".", s["from_col"], " = ", s["to_name"], ".", s["to_col"])


def _of_first(tables: Column, column) -> Column:
    """(table, name), name qualified: the column of the first table that has one."""
    return first(
        F.filter(F.transform(tables, lambda t: F.struct(t["key"].alias("table"), _qualified(t, column(t)).alias("name"))), lambda c: c["name"].isNotNull())
    )


def _group(df: DataFrame) -> DataFrame:
    """Add ``_group`` (table, name): what totals are grouped by, a column or (name null) the entity of a table; null if the question doesn't say."""

    def base(c: Column) -> Column:
        return F.replace(F.replace(c["key"], F.lit("_id"), F.lit("")), F.lit("_name"), F.lit(""))

    def column(t: Column, c: Column) -> Column:
        return F.struct(t["key"].alias("table"), c["name"].alias("name"))

    def columns(keep) -> Column:
        return first(F.flatten(F.transform("involved", lambda t: F.transform(F.filter(t["cols"], keep), lambda c: column(t, c)))))

    stem = lambda t: F.regexp_replace(t["key"], "s+$", "")
    entity = first(F.filter("involved", lambda t: F.exists("group_words", lambda w: F.regexp_replace(w, "s+$", "") == stem(t))))
    hinted = columns(lambda c: c["name"] == F.col("group_col"))
    spoken = columns(lambda c: ~c["is_pk"] & ~c["is_fk"] & ~c["as_number"] & (F.length(base(c)) >= 2) & F.array_contains("group_words", base(c)))
    table = F.when(entity.isNotNull(), F.struct(entity["key"].alias("table"), F.lit(None).cast("string").alias("name")))
    return settled(df.withColumn("_group", F.when(F.col("agg").isNotNull(), F.coalesce(hinted, table, spoken))), "_group")


def _sum_of(agg: str, alias: Column, table: Column) -> Column:
    """A total over rows of a derived table, each of which holds the totals of one key."""
    cell = _text(table, ".", alias)
    return {"avg": _text("SUM(", cell, ") / SUM(", table, ".n_", alias, ")"), "max": _text("MAX(", cell, ")"), "min": _text("MIN(", cell, ")")}.get(
        agg, _text("SUM(", cell, ")")
    )


def _joined(df: DataFrame) -> DataFrame:
    """Drafts for questions over several tables.

    A foreign key says that many rows of its table belong to one of the other. Where totals of a table would meet more
    details than their own on the way from the listed rows, each table with totals is added up by its key in a query of its own
    first, and tables that only restrict are tested by IN, so that no row is counted twice.
    """
    df = _group(df)
    chosen = first(F.filter("involved", lambda t: t["key"] == F.col("_group.table")))
    df = df.withColumn("_primary", F.coalesce(chosen, primary_table(F.col("involved"))))
    df = df.withColumn("_others", F.filter("involved", lambda t: t["key"] != F.col("_primary.key")))
    df = _with_paths(df)
    df = df.withColumn("_ordered", F.concat(F.array("_primary"), "_others"))
    primary, others, ordered = F.col("_primary"), F.col("_others"), F.col("_ordered")
    asked = F.filter("_others", lambda t: F.array_contains("asked", t["key"]))
    df = settled(df.withColumn("_asked", F.concat(asked, F.filter("_others", lambda t: ~F.array_contains("asked", t["key"])))), "_asked", "steps", "_ordered", "_primary", "_others")

    # filters, each with the table it is about
    category = lambda t: first(
        F.filter(t["cols"], lambda c: (c["family"] == "text") & any_of(c["key"], JOINED_CATEGORY_WORDS))
    )["name"]
    said_date = lambda t: first(F.filter(t["cols"], lambda c: c["as_date"] & F.array_contains("cols_named", c["key"])))["name"]
    lead = F.coalesce(first(F.col("measures"))["table"], first(F.filter("involved", lambda t: F.exists(t["cols"], lambda c: c["name"] == F.col("order_col"))))["key"])
    leading = F.concat(F.filter("_ordered", lambda t: t["key"] == lead), "_ordered")
    date = F.coalesce(_of_first(ordered, said_date), _of_first(leading, lambda t: first(t["date"])))
    status = _of_first(leading, lambda t: _named(t, "status"))
    value = _of_first(ordered, category)
    cond = lambda table, text: F.struct(table.alias("table"), text.alias("text"))
    compared = F.transform(
        "comparisons",
        lambda c: F.transform(F.array(resolve_numeric(F.col("involved"), c["col"])), lambda f: cond(F.lower(f["table"]), _text(f["table"], ".", f["name"], " ", c["op"], " ", c["number"])))[0],
    )
    plain = F.array(
        cond(date["table"], _in_year(date["name"])),
        cond(status["table"], _has_status(status["name"])),
        cond(value["table"], _equals(value["name"], first(F.col("value_words")))),
    )
    df = settled(df.withColumn("_conds", F.filter(F.concat(compared, plain), lambda c: c["text"].isNotNull())), "_conds")

    # totals, each with the table it is taken from
    number = _of_first(F.col("_asked"), lambda t: first(t["numeric"]))
    own = F.struct(F.col("_primary.key").alias("table"), _qualified(primary, first(primary["numeric"])).alias("name"))
    named = F.transform(
        F.filter("measures", lambda m: F.exists("involved", lambda t: t["key"] == m["table"])),
        lambda m: F.struct(m["table"].alias("table"), _text(_declared(m["table"]), ".", m["name"]).alias("name")),
    )
    some = F.array_compact(F.array(F.coalesce(number, F.when(own["name"].isNotNull(), own))))
    totals = F.when(F.col("agg_stated") & (F.col("agg") != "count"), F.when(F.size(named) > 0, named).otherwise(some)).otherwise(
        F.array().cast("array<struct<table:string,name:string>>")
    )
    df = settled(df.withColumn("_totals", totals), "_totals")
    measured = F.array_distinct(
        F.when(F.size("_totals") > 0, F.transform("_totals", lambda m: m["table"])).otherwise(
            F.transform(F.filter("_asked", lambda t: F.array_contains("asked", t["key"])), lambda t: t["key"])
        )
    )
    holds_key = lambda s: F.exists(
        "tables",
        lambda t: (t["key"] == s["to_table"])
        & F.exists(t["cols"], lambda c: (c["name"] == s["to_col"]) & ((c["is_fk"] & (F.lower(c["fk_table"]) == s["from_table"])) | (~c["is_pk"] & ~c["is_fk"]))),
    )
    df = settled(df.withColumns({"_measured": measured, "_down": F.transform(F.filter("steps", holds_key), lambda s: s["to_table"])}), "_measured", "_down")

    on_path = lambda m: F.flatten(F.transform(F.filter("paths", lambda p: p["to_table"] == m), lambda p: F.transform(p["steps"], lambda s: s["to_table"])))
    off_path = lambda m: F.size(F.array_except("_down", on_path(m))) > 0
    fans_out = F.coalesce(F.exists("_measured", off_path), F.lit(False)) & (F.size("_totals") > 0) | (
        (F.size("_totals") == 0) & (F.size("_measured") > 1) & F.exists("_measured", off_path)
    )
    df = settled(df.withColumn("_fans", F.col("agg").isNotNull() & F.coalesce(fans_out, F.lit(False))), "_fans")
    df = settled(df.withColumn("_tests", F.when(F.col("_fans"), _tests())), "_tests")

    source = _text(primary["name"], F.array_join(F.transform("steps", _step_text), ""))
    where = _clause("WHERE", F.nullif(F.array_join(F.transform("_conds", lambda c: c["text"]), " AND "), F.lit("")), sep=" AND ")
    entity = F.concat_ws(", ", _qualified(primary, primary["id_col"]), _qualified(primary, primary["name_col"]))
    who = F.coalesce(_qualified(primary, F.col("_group.name")), entity)
    df = settled(df.withColumns({"_source": source, "_where": where, "_who": who}), "_source", "_where", "_who")
    source, where, who = F.col("_source"), F.col("_where"), F.col("_who")

    alias_of = lambda name: _alias(F.substring_index(name, ".", -1))
    sums = F.transform("_totals", lambda m: _text(_total(m["name"]), " AS ", alias_of(m["name"])))
    rows = F.when((F.size("_totals") == 0) & (F.col("agg") == "count"), F.array(F.lit("COUNT(*) AS count_rows"))).otherwise(F.array().cast("array<string>"))
    lead_alias = F.coalesce(alias_of(first(F.col("_totals"))["name"]), F.when(F.col("agg") == "count", F.lit("count_rows")))
    distinct = F.when(
        F.col("wants_count"), _text("COUNT(DISTINCT ", _of_first(F.col("_asked"), lambda t: t["id_col"])["name"], ") AS count_distinct")
    )
    tie = F.when(F.col("_group.name").isNull(), _tie(primary)).otherwise("")
    aggregate = _text(
        "SELECT ",
        F.concat_ws(", ", F.nullif(who, F.lit("")), F.concat(sums, rows), distinct),
        " FROM ",
        source,
        where,
        F.when(who != "", _text(" GROUP BY ", who)).otherwise(""),
        F.coalesce(_text(" ORDER BY ", lead_alias, " DESC", tie), F.lit("")),
        _limit(),
    )
    listed_number = F.coalesce(first(F.transform(F.filter("measures", lambda m: m["table"] != F.col("_primary.key")), lambda m: _text(_declared(m["table"]), ".", m["name"]))), _of_first(others, lambda t: first(t["numeric"]))["name"])
    listed = F.concat_ws(", ", F.nullif(entity, F.lit("")), listed_number)
    columns = (
        F.when(F.col("select_all"), "*").when(listed != "", listed).otherwise(_text(primary["name"], ".*"))
    )
    hinted = _of_first(ordered, lambda t: first(F.filter(t["cols"], lambda c: c["name"] == F.col("order_col")))["name"])["name"]
    lead_by = F.coalesce(hinted, _qualified(primary, first(primary["numeric"])))
    worded = _of_first(ordered, lambda t: first(F.filter(t["cols"], lambda c: c["name"] == F.col("text_order")))["name"])["name"]
    listing = _text(
        "SELECT ", columns, " FROM ", source, where,
        _clause("ORDER BY", F.coalesce(_text(worded, " ASC"), _text(lead_by, _direction(F.col("order_desc"))))), _limit(),
    )
    sql = F.when(F.col("_fans"), _added_up(primary, who, tie)).when(F.col("agg").isNotNull(), aggregate).otherwise(listing)
    unused = F.array(
        F.when((F.size("years") > 0) & date["name"].isNull(), _said_years()),
        F.when(status["name"].isNull(), F.col("status")),
        F.when(F.col("agg").isNotNull(), _text("order by ", F.col("order_col"))),
        F.when(F.col("agg").isNull() & F.col("text_order").isNull(), _text("by ", F.col("group_col"))),
    )
    values = F.slice("value_words", F.when(value["name"].isNull(), 1).otherwise(2), F.lit(1 << 30))
    lost = F.filter("comparisons", lambda c: resolve_numeric(F.col("involved"), c["col"]).isNull())
    return df.withColumns({"_join_sql": sql, "_join_unused": F.concat(F.array_compact(unused), values, _said_comparisons(lost))})


def _path_of(table: Column) -> Column:
    return first(F.filter("paths", lambda p: p["to_table"] == table))["steps"]


def _conds_of(keys: Column) -> Column:
    """Texts of the filters about some tables."""
    return F.transform(F.filter("_conds", lambda c: F.array_contains(keys, c["table"])), lambda c: c["text"])


def _all_of(parts: Column) -> Column:
    return F.when(F.size(parts) > 0, _text(" WHERE ", F.array_join(parts, " AND "))).otherwise("")


def _tests() -> Column:
    """(table, text): the tables off all ways to totals, with all that hangs on them, as tests by IN of the table they hang on."""
    on_paths = F.array_distinct(F.flatten(F.transform("_measured", lambda m: F.transform(_path_of(m), lambda x: x["to_table"]))))
    off = F.filter("steps", lambda x: ~F.array_contains(on_paths, x["to_table"]))
    # where a step off the ways begins, and the steps beyond it
    roots = F.filter(off, lambda x: ~F.exists(off, lambda y: y["to_table"] == x["from_table"]))
    with_rest = F.transform(
        roots,
        lambda r: F.struct(
            r.alias("step"),
            F.filter(
                off,
                lambda x: (x["to_table"] != r["to_table"])
                & F.exists(_path_of(x["to_table"]), lambda y: y["to_table"] == r["to_table"]),
            ).alias("rest"),
        ),
    )
    return F.transform(
        with_rest,
        lambda w: F.struct(
            w["step"]["from_table"].alias("table"),
            _text(
                w["step"]["from_name"], ".", w["step"]["from_col"], " IN (SELECT ", w["step"]["to_name"], ".", w["step"]["to_col"], " FROM ", w["step"]["to_name"],
                F.array_join(F.transform(w["rest"], _step_text), ""),
                _all_of(_conds_of(F.concat(F.array(w["step"]["to_table"]), F.transform(w["rest"], lambda x: x["to_table"])))), ")",
            ).alias("text"),
        ),
    )


def _added_up(primary: Column, who: Column, tie: Column) -> Column:
    """The statement whose totals are added up by key before they meet. Totals of the listed table itself are plain."""
    agg = F.col("agg")
    here = F.col("_primary.key")
    measured = F.filter("_measured", lambda m: m != here)
    restricted = lambda keys: _all_of(
        F.concat(_conds_of(keys), F.transform(F.filter("_tests", lambda x: F.array_contains(keys, x["table"])), lambda x: x["text"]))
    )
    name_of = lambda m: F.substring_index(m["name"], ".", -1)
    is_avg = agg == "avg"
    totals_of = lambda m: F.filter("_totals", lambda x: x["table"] == m)

    def cells(m: Column) -> Column:
        """Totals of a derived table: avg as sum and number, so that they can be added on."""
        one = lambda x: F.when(
            is_avg, _text("SUM(", x["name"], ") AS ", _alias(name_of(x)), ", COUNT(", x["name"], ") AS n_", _alias(name_of(x)))
        ).otherwise(_text(_total(x["name"]), " AS ", _alias(name_of(x))))
        return F.when(F.size(totals_of(m)) > 0, F.array_join(F.transform(totals_of(m), one), ", ")).otherwise(_text("COUNT(*) AS count_", m))

    def derived(m: Column) -> Column:
        path = _path_of(m)
        keys = F.transform(path, lambda s: s["to_table"])
        head = first(path)
        link = _text(head["to_name"], ".", head["to_col"])
        return _text(
            F.when(F.size(measured) > 1, " LEFT JOIN (SELECT ").otherwise(" JOIN (SELECT "), link, " AS link, ", cells(m), " FROM ", head["to_name"],
            F.array_join(F.transform(F.slice(path, 2, 1 << 30), _step_text), ""), restricted(keys),
            " GROUP BY ", link, ") AS per_", m, " ON ", primary["name"], ".", head["from_col"], " = per_", m, ".link",
        )

    def outer(m: Column) -> Column:
        table = _text("per_", m)

        def one(x: Column) -> Column:
            a = _alias(name_of(x))
            made = F.when(agg == "avg", _sum_of("avg", a, table)).when(agg == "max", _sum_of("max", a, table)).when(agg == "min", _sum_of("min", a, table)).otherwise(_sum_of("sum", a, table))
            return _text(made, " AS ", a)

        return F.when(F.size(totals_of(m)) > 0, F.array_join(F.transform(totals_of(m), one), ", ")).otherwise(_text("SUM(", table, ".count_", m, ") AS count_", m))

    plain = F.transform(totals_of(here), lambda x: _text(_total(x["name"]), " AS ", _alias(name_of(x))))
    lead = F.coalesce(_alias(name_of(first(F.col("_totals")))), _text("count_", first(measured)))
    return _text(
        "SELECT ", F.concat_ws(", ", F.nullif(who, F.lit("")), F.concat(plain, F.transform(measured, outer))), " FROM ", primary["name"],
        F.array_join(F.transform(measured, derived), ""), restricted(F.array(here)),
        F.when(who != "", _text(" GROUP BY ", who)).otherwise(""), " ORDER BY ", lead, " DESC", tie, _limit(),
    )


def _said_years() -> Column:
    return F.array_join(F.transform("years", lambda y: _text("year ", y["op"], " ", y["year"].cast("string"))), ", ")


def _said_comparisons(items: Column) -> Column:
    return F.transform(items, lambda c: F.concat_ws(" ", F.nullif(c["col"], F.lit("")), c["op"], c["number"]))


def _unused(t: Column) -> Column:
    """What a question over one table, a "never" question or one about spend asks for beyond what its draft says."""
    single = F.col("shape").isin("listing", "aggregate")
    anti, spend = F.col("shape") == "anti", F.col("shape") == "spend"
    date = F.when(single, first(t["date"])).when(anti, first(F.col("_via.date"))).otherwise(first(F.col("_orders.date")))
    status = F.when(single, _named(t, "status")).when(anti, _named(F.col("_via"), "status")).otherwise(_named(F.col("_orders"), "status"))
    has_col = lambda name: F.exists(t["cols"], lambda c: c["name"] == F.col(name))
    listing = F.col("shape") == "listing"
    parts = F.array(
        F.when((F.size("years") > 0) & date.isNull(), _said_years()),
        F.when(status.isNull(), F.col("status")),
        F.when(~(listing & has_col("order_col")), _text("order by ", F.col("order_col"))),
        F.when(
            ~((F.col("shape") == "aggregate") & has_col("group_col")) & ~(listing & F.col("text_order").isNotNull()) & ~spend,
            _text("by ", F.col("group_col")),
        ),
        F.when(anti, _text("limit ", F.col("limit_n").cast("string"))),
    )
    taken = F.when(single & (F.size(t["category"]) > 0), 2).otherwise(1)
    lost = F.filter("comparisons", lambda c: ~single | resolve_numeric(F.col("involved"), c["col"]).isNull())
    return F.concat(F.array_compact(parts), F.slice("value_words", taken, F.lit(1 << 30)), _said_comparisons(lost))


def _quoted(sql: Column) -> Column:
    """The statement with names that are no plain words in quotes: each is replaced by its place first, so that none is quoted inside another."""
    odd = F.sort_array(
        F.array_distinct(
            F.transform(
                F.filter(F.flatten(F.transform("tables", lambda t: F.concat(F.array(t["name"]), F.transform(t["cols"], lambda c: c["name"])))), lambda n: n.rlike(r"\W|^\d")),
                lambda n: F.struct(-F.length(n), n.alias("name")),
            )
        )
    )
    place = lambda i: F.concat(F.lit("\u0002"), i.cast("string"), F.lit("\u0002"))
    numbered = F.transform(odd, lambda n, i: F.struct(n["name"].alias("name"), place(i).alias("place")))
    marked = F.aggregate(numbered, sql, lambda text, n: F.replace(text, n["name"], n["place"]))
    in_quotes = lambda n: F.concat(F.lit('"'), F.replace(n, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(F.size(odd) == 0, sql).otherwise(F.aggregate(numbered, marked, lambda text, n: F.replace(text, n["place"], in_quotes(n["name"]))))


def draft_sql(corpus: DataFrame, spend_tables: tuple[str, str, str] = SPEND_TABLES) -> DataFrame:
    """One draft per corpus row (row_id, ddl, question): row_id, shape, sql, problem.

    Questions that need a join without a usable key get no statement but the reason. Where a draft leaves out a part of the
    question that was understood, ``problem`` names that part beside the statement.
    """
    df = with_shape(with_involved(question_features(corpus.select("row_id", "ddl", "question"))), spend_tables)
    df = _spend(_anti(df.withColumn("_t", first(F.col("involved")))), spend_tables)
    sql = (
        F.when(F.col("shape") == "listing", _listing(F.col("_t")))
        .when(F.col("shape") == "aggregate", _aggregate(F.col("_t")))
        .when(F.col("shape") == "anti", F.col("_anti_sql"))
        .when(F.col("shape") == "spend", F.col("_spend_sql"))
    )
    to_join = F.col("shape") == "join"
    unused = F.when(~to_join, _unused(F.col("_t")))
    # a finished draft keeps its text only, a join question the columns its draft still needs
    staged = settled(
        df.withColumns({"sql": sql, "_unused": unused}).select(
            "row_id", "shape", "sql", "_unused", "tables", *[F.when(to_join, F.col(c)).alias(c) for c in _JOIN_INPUT if c != "tables"]
        ),
        "shape",
        "sql",
        "_unused",
        *_JOIN_INPUT,
    )
    drafts = _joined(staged).select(
        "row_id",
        "shape",
        _quoted(F.when(to_join, F.col("_join_sql")).otherwise(F.col("sql"))).alias("sql"),
        F.when(to_join, F.col("_join_unused")).otherwise(F.col("_unused")).alias("_left"),
    )
    problem = (
        F.when(F.col("shape").isNull(), NO_TABLE)
        .when(F.col("sql").isNull(), NO_PATH)
        .when(F.size("_left") > 0, _text(LEFT_OUT, F.array_join("_left", ", ")))
    )
    return drafts.withColumn("problem", problem).drop("_left")
