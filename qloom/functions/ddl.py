"""Table definitions read out of a text column, as native array expressions.

Every row carries its own definitions, so reading them needs no shuffle and no row waits for another.
The result is an array of tables:
``struct<ord, name, key, cols: array<struct<ord, name, key, dtype, precision, scale, family, is_pk,
is_fk, fk_table, fk_column, ...role flags>>, id_col, name_col, category, numeric, date, text>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.stages import settled

# Type words by family, and the words that give a column its role.
NUMERIC_TYPES = (
    "INT", "INTEGER", "BIGINT", "SMALLINT", "TINYINT", "DECIMAL", "NUMERIC", "FLOAT", "DOUBLE", "REAL", "SERIAL",
)
DATE_TYPES = ("DATE", "DATETIME", "TIMESTAMP")
TEXT_TYPES = ("VARCHAR", "CHAR", "TEXT", "CLOB")
PLAIN_TYPES = ("BOOLEAN", "BOOL", "BLOB", "UUID")
NAME_WORDS = (
    "name", "title", "label", "description", "username", "first_name", "last_name", "full_name", "email",
    "doctor", "driver", "instructor", "airline", "brand", "subject", "reason",
)
CATEGORY_WORDS = (
    "status", "type", "category", "tier", "level", "department", "dept", "country", "city", "state", "region",
    "genre", "specialty", "course", "method", "plan", "priority", "role", "gender", "location",
)
# End of fixed values.

# stands on both sides of the number of a quoted name
_PLACE = "\u0002"
# strings, comments and quoted names, in the order of the text
_QUOTES = r"""(?s)'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/|"(?:[^"]|"")*"|`(?:[^`]|``)*`|\[[^\[\]\d][^\[\]]*\]"""
_NAME = r'["`\[]?([\w\x02]+)["`\]]?'
_PREFIX = r'(?:["`\[]?[\w\x02]+["`\]]?\s*\.\s*)*'
_TABLE = r"CREATE\s+(?:OR\s+REPLACE\s+)?(?:(?:GLOBAL|LOCAL)\s+)?(?:(?:TEMP|TEMPORARY|EXTERNAL|UNLOGGED)\s+)?TABLE\b"
_CREATE = rf"(?is)^\s*{_TABLE}\s*(?:IF\s+NOT\s+EXISTS\s+)?{_PREFIX}{_NAME}\s*\((.*)\)"
_STATEMENT_END = rf"(?i);|(?=\b{_TABLE})"
_PRIMARY = r"(?i)^PRIMARY\s+KEY\s*\(([^)]+)\)"
_TARGET = rf"REFERENCES\s+{_PREFIX}{_NAME}\s*\(\s*{_NAME}\s*\)"
_FOREIGN = rf"(?i)^(?:CONSTRAINT\s+\S+\s+)?FOREIGN\s+KEY\s*\(([^)]+)\)\s*REFERENCES\s+{_PREFIX}{_NAME}\s*\(([^)]+)\)"
_CLAUSE = r"(?i)^(?:(?:CONSTRAINT|CHECK|INDEX|UNIQUE|PRIMARY|FOREIGN)\b|KEY\s+\w+\s*\(\s*[\"`\[]?[a-z_])"
_COLUMN = rf"(?is)^{_NAME}\s+(\w+)(?:\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?"


def _plain(name: Column) -> Column:
    """A name as it was declared: a quoted one is put back from its numbered place."""
    place = F.translate(name, _PLACE, "").try_cast("int")
    return F.when(F.startswith(name, F.lit(_PLACE)), F.get("_quoted", place)).otherwise(name)


def _listed(names: Column) -> Column:
    """The names of a comma-separated list, without quotes."""
    return F.transform(F.split(names, ","), lambda c: _plain(F.regexp_replace(c, r"[^\w\x02]", "")))


def _unquoted(token: Column) -> Column:
    """The name in a quoted token, null for strings and comments; a doubled quote stands for one."""
    mark = F.substring(token, 1, 1)
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    return F.when(mark.isin('"', "`"), F.replace(inner, F.concat(mark, mark), mark)).when(mark == "[", inner)


def _with_places(df: DataFrame, ddl: str) -> DataFrame:
    """Add ``_quoted``, the quoted names, and ``_text`` with a numbered place for each of them, and a blank for each string and comment."""
    text = F.coalesce(ddl, F.lit(""))
    df = df.withColumn("_quoted", F.transform(F.regexp_extract_all(text, F.lit(_QUOTES), F.lit(0)), _unquoted))
    df = settled(df, "_quoted")
    name = lambda i: F.concat(F.lit('"' + _PLACE), i.cast("string"), F.lit(_PLACE + '"'))
    filled = F.transform(
        F.split(text, _QUOTES, -1),
        lambda p, i: F.concat(p, F.when(i >= F.size("_quoted"), "").when(F.get("_quoted", i).isNull(), " ").otherwise(name(i))),
    )
    return df.withColumn("_text", F.array_join(filled, ""))


def any_of(col: Column, words: tuple[str, ...]) -> Column:
    """Whether a text contains one of the given words."""
    return col.rlike("|".join(words))


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def type_family(dtype: Column) -> Column:
    """Family of an upper-case type word; 'none' for known types without one, 'other' for unknown words."""
    return (
        F.when(dtype.isin(*NUMERIC_TYPES), "numeric")
        .when(dtype.isin(*DATE_TYPES), "date")
        .when(dtype.isin(*TEXT_TYPES), "text")
        .when(dtype.isin(*PLAIN_TYPES), "none")
        .otherwise("other")
    )


def top_level_items(body: Column) -> Column:
    """Split at commas outside parentheses, at any depth.

    The text is cut at every comma, and the pieces are put together again while a bracket is open.
    """

    def count(text: Column, mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    start = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("depth")
    )

    # brackets are counted once per piece, as the fold writes the depth several times
    pieces = F.transform(F.split(body, ","), lambda p: F.struct(p.alias("text"), (count(p, "(") - count(p, ")")).alias("opens")))

    def step(acc: Column, piece: Column) -> Column:
        text = F.concat_ws(",", acc["open"], piece["text"])
        depth = acc["depth"] + piece["opens"]
        closed = depth == 0
        return F.struct(
            F.when(closed, F.concat(acc["done"], F.array(text))).otherwise(acc["done"]).alias("done"),
            F.when(~closed, text).alias("open"),
            depth.alias("depth"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(acc["done"], F.array_compact(F.array(acc["open"])))

    return F.aggregate(pieces, start, step, finish)


_MARK = "\u0001"


def _columns(items: Column) -> Column:
    """Column definitions among the items of a table.

    Each step is a transform of its own: inside one array function Spark evaluates a repeated
    expression every time it is written.
    """
    is_column = lambda i: i.rlike(_COLUMN) & ~i.rlike(_CLAUSE)
    cut = F.transform(
        F.filter(items, is_column),
        lambda i: F.struct(
            F.split(F.regexp_replace(i, f"{_COLUMN}.*$", _MARK.join(("$1", "$2", "$3", "$4"))), _MARK).alias("words"),
            i.rlike(r"(?i)PRIMARY\s+KEY").alias("is_pk"),
            F.when(i.rlike("(?i)REFERENCES"), F.regexp_extract(i, f"(?i){_TARGET}", 0)).alias("target"),
        ),
    )
    typed = F.transform(
        cut,
        lambda c: F.struct(
            _plain(c["words"][0]).alias("name"),
            F.upper(c["words"][1]).alias("dtype"),
            # null first: a failed cast costs an exception per column
            F.nullif(c["words"][2], F.lit("")).try_cast("int").alias("precision"),
            F.nullif(c["words"][3], F.lit("")).try_cast("int").alias("scale"),
            c["is_pk"].alias("is_pk"),
            _plain(F.nullif(F.regexp_extract(c["target"], f"(?i){_TARGET}", 1), F.lit(""))).alias("fk_table"),
            _plain(F.nullif(F.regexp_extract(c["target"], f"(?i){_TARGET}", 2), F.lit(""))).alias("fk_column"),
        ),
    )

    def finished(c: Column) -> Column:
        decimal = c["dtype"].isin("DECIMAL", "NUMERIC")
        return F.struct(
            c["name"].alias("name"),
            F.lower(c["name"]).alias("key"),
            c["dtype"].alias("dtype"),
            F.when(decimal, F.coalesce(c["precision"], F.lit(10))).alias("precision"),
            F.when(decimal, F.coalesce(c["scale"], F.lit(0))).alias("scale"),
            type_family(c["dtype"]).alias("family"),
            c["is_pk"].alias("is_pk"),
            c["fk_table"].alias("fk_table"),
            c["fk_column"].alias("fk_column"),
        )

    return F.transform(typed, finished)


def _key_clauses(items: Column) -> tuple[Column, Column]:
    """Columns of primary-key clauses, and (key, table, column) of foreign-key clauses."""
    primary = F.flatten(
        F.transform(
            F.filter(items, lambda i: i.rlike(_PRIMARY)),
            lambda i: F.transform(_listed(F.regexp_extract(i, _PRIMARY, 1)), F.lower),
        )
    )
    foreign = F.flatten(
        F.transform(
            F.filter(items, lambda i: i.rlike(_FOREIGN)),
            lambda i: F.zip_with(
                _listed(F.regexp_extract(i, _FOREIGN, 1)),
                _listed(F.regexp_extract(i, _FOREIGN, 3)),
                lambda own, theirs: F.struct(
                    F.lower(own).alias("key"),
                    _plain(F.regexp_extract(i, _FOREIGN, 2)).alias("fk_table"),
                    theirs.alias("fk_column"),
                ),
            ),
        )
    )
    return primary, foreign


def _with_keys(table: Column) -> Column:
    """Columns of a table with its key clauses applied, and flags for the roles they may take."""
    plain = ("name", "key", "dtype", "precision", "scale", "family")
    keyed = F.transform(
        table["cols"],
        lambda c: F.struct(
            *[c[f].alias(f) for f in plain],
            (c["is_pk"] | F.array_contains(table["primary"], c["key"])).alias("is_pk"),
            F.coalesce(
                last(F.filter(table["foreign"], lambda f: f["key"] == c["key"])),
                F.when(
                    c["fk_table"].isNotNull(),
                    F.struct(c["key"].alias("key"), c["fk_table"].alias("fk_table"), c["fk_column"].alias("fk_column")),
                ),
            ).alias("target"),
        ),
    )
    return F.transform(
        keyed,
        lambda c, i: F.struct(
            i.alias("ord"),
            *[c[f].alias(f) for f in plain],
            c["is_pk"].alias("is_pk"),
            c["target"].isNotNull().alias("is_fk"),
            c["target"]["fk_table"].alias("fk_table"),
            c["target"]["fk_column"].alias("fk_column"),
            *_role_flags(c),
        ),
    )


def _role_flags(c: Column) -> list[Column]:
    shown = c["is_pk"] | c["target"].isNull()
    text = shown & (c["family"] == "text")
    number = (c["family"] == "numeric") & ~c["is_pk"] & c["target"].isNull()
    return [
        (text & any_of(c["key"], NAME_WORDS)).alias("as_name"),
        (text & any_of(c["key"], CATEGORY_WORDS)).alias("as_category"),
        (number & ~F.endswith(c["key"], F.lit("_id"))).alias("as_number"),
        (shown & (c["family"] == "date")).alias("as_date"),
        text.alias("as_text"),
    ]


def _names(cols: Column, keep) -> Column:
    return F.transform(F.filter(cols, keep), lambda c: c["name"])


def with_tables(df: DataFrame, ddl: str = "ddl") -> DataFrame:
    """Add ``tables``, the parsed definitions of each row.

    A table defined twice keeps its first place and its last definition.
    """
    df = _with_places(df, ddl)
    statements = F.filter(F.split("_text", _STATEMENT_END), lambda s: s.rlike(_CREATE))
    trimmed = lambda i: F.regexp_replace(i, r"^\s+|\s+$", "")
    raw = F.transform(
        statements,
        lambda s: F.struct(
            F.regexp_extract(s, _CREATE, 1).alias("name"),
            F.transform(top_level_items(F.regexp_extract(s, _CREATE, 2)), trimmed).alias("items"),
        ),
    )

    def clauses(t: Column) -> Column:
        primary, foreign = _key_clauses(t["items"])
        return F.struct(
            _plain(t["name"]).alias("name"),
            F.lower(_plain(t["name"])).alias("key"),
            primary.alias("primary"),
            foreign.alias("foreign"),
            _columns(t["items"]).alias("cols"),
        )

    def keyed(t: Column) -> Column:
        return F.struct(t["name"].alias("name"), t["key"].alias("key"), _with_keys(t).alias("cols"))

    def named(t: Column) -> Column:
        return F.struct(
            t["name"].alias("name"),
            t["key"].alias("key"),
            t["cols"].alias("cols"),
            first(_names(t["cols"], lambda c: c["as_name"])).alias("named"),
        )

    def roles(t: Column, ord_: Column) -> Column:
        cols = t["cols"]
        other = _names(cols, lambda c: c["as_text"] & ~c["as_category"] & ~c["name"].eqNullSafe(t["named"]))
        return F.struct(
            ord_.alias("ord"),
            t["name"].alias("name"),
            t["key"].alias("key"),
            cols.alias("cols"),
            first(_names(cols, lambda c: c["is_pk"])).alias("id_col"),
            F.coalesce(t["named"], first(other)).alias("name_col"),
            _names(cols, lambda c: c["as_category"]).alias("category"),
            _names(cols, lambda c: c["as_number"]).alias("numeric"),
            _names(cols, lambda c: c["as_date"]).alias("date"),
            other.alias("text"),
        )

    staged = df.withColumn("_raw", F.transform(F.transform(F.transform(raw, clauses), keyed), named))
    staged = staged.withColumn("_keys", F.array_distinct(F.transform("_raw", lambda t: t["key"])))
    unique = F.when(F.size("_keys") == F.size("_raw"), F.col("_raw")).otherwise(
        F.transform("_keys", lambda k: last(F.filter("_raw", lambda t: t["key"] == k)))
    )
    return settled(staged.withColumn("tables", F.transform(unique, roles)).drop("_raw", "_keys", "_quoted", "_text"), "tables")
