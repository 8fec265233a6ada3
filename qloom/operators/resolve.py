"""Whether the names in a statement exist in the definitions given beside it.

This is a check of names, not of grammar, and no statement is run: it is stricter than executing on
empty tables where a name is unknown, and looser on syntax. It is reported under its own name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.ddl import first, with_tables
from qloom.functions.stages import choose, settled
from qloom.operators.evaluation import rate

# Words of the language that are never reported as names.
KEYWORDS = (
    "all and any as asc between by case cast cross current_date current_time current_timestamp desc distinct else end escape "
    "except exists false fetch filter first for from full group having ilike in inner intersect interval into is join last lateral left like limit "
    "natural next not null nulls offset on only or order outer over qualify recursive right rows select some then ties true union using values when "
    "where window with within"
).split()
# words of a window's definition
WINDOW_WORDS = "partition rows range groups preceding following current row unbounded exclude no others order by".split()
CAST_FUNCTIONS = ("cast", "try_cast", "safe_cast", "convert")
LITERAL_TYPES = ("date", "time", "timestamp", "interval")
# End of fixed values.

_TOKEN = (
    r"""(?s)'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/|"(?:[^"]|"")*"|`(?:[^`]|``)*`|\[[^\[\]\d][^\[\]]*\]|[\p{L}_][\p{L}\p{N}_$]*|\d[\p{L}\p{N}_.]*|::|[^\s\w]"""
)
_SUBQUERY = "("
# kinds of words; those from IDENT on are names
OPEN, CLOSE, COMMA, DOT, SEMICOLON, STRING, NUMBER, CASTS, SIGN = range(1, 10)
SELECT, FROM, JOIN, WITH, AS, ON, ENDS, ORDER, UNION, END, RECURSIVE, OVER, INTERVAL, WINDOW, WORD = range(10, 25)
IDENT, CASTING, EXTRACT, TYPE, FRAME = range(30, 35)
# kinds of brackets
BRACKET, QUERY, OVER_WINDOW, CAST, FIELD, LIST, NAMED_WINDOW = range(7)
# what the last name was
NOTHING, REF, NAME, ALIAS, SOURCE, REST, SKIPPED, CTE, WINDOWS, UNIT, COLUMN = range(11)
_LEVEL = "struct<scope:int,root:int,kind:int,infrom:boolean,src:int>"
# Names are kept as places of their words, three numbers an entry: a fold copies its state after each word, and numbers are quickly copied.
_ENTRIES = {"sources": ("scope", "name", "alias"), "names": ("scope", "cte", "name"), "refs": ("scope", "of", "col")}
_STATE = {
    "at": "int", "now": _LEVEL, "stack": f"array<{_LEVEL}>", "parents": "array<int>", "outer": "array<int>", "prev": "int", "prev2": "int", "k1": "int",
    "last": "int", "with_depth": "int", "want": "boolean", "union": "boolean", **{f: "array<int>" for f in _ENTRIES},
}
# places of no word and of a subquery
_NO_WORD, _DERIVED = -1, -2


def _struct(kind: str, *values) -> Column:
    fields = [f.split(":")[0] for f in kind[len("struct<") : -1].split(",")]
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(f) for f, v in zip(fields, values)])


def _all_but_last(items: Column) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))


def _words_of(sql: Column) -> Column:
    """Lower-case tokens: names without their quotes, a quote for a string, no comments."""
    raw = F.filter(F.regexp_extract_all(F.lower(sql), F.lit(_TOKEN), F.lit(0)), lambda t: ~t.rlike(r"^(?:--|/\*)"))
    inner = lambda t: F.regexp_replace(F.substring(t, F.lit(2), F.length(t) - 2), r'""|``', '"')
    return F.transform(raw, lambda t: F.when(F.startswith(t, F.lit("'")), "'").when(t.rlike(r"^[\"`]|^\[."), inner(t)).otherwise(t))


def _read(words: Column) -> Column:
    """Scopes, sources, declared names and references of a statement, by one fold over the kinds of its words.

    Every SELECT has a scope of its own whose parent is the one around its bracket; brackets of other kinds (functions, casts,
    windows, lists of columns) keep the scope. A level of brackets knows whether it is in a FROM clause, and whether a
    source (1), its alias (2) or the rest of a dotted name (3) is due.
    """
    level = _struct(_LEVEL, 0, 0, QUERY, False, 0)
    empty = {"boolean": F.lit(False), "int": F.lit(0), _LEVEL: level}
    first_of = {"parents": F.array(F.lit(-1)), "outer": F.array(F.lit(-1)), "with_depth": F.lit(-1), "prev": F.lit(_NO_WORD), "prev2": F.lit(_NO_WORD)}
    start = F.struct(*[first_of.get(f, empty.get(k, F.array())).cast(k).alias(f) for f, k in _STATE.items()])
    found = lambda done: F.struct(
        done["parents"].alias("parents"), done["outer"].alias("outer"), *[_entries(done[f], words, f).alias(f) for f in _ENTRIES]
    )
    return F.aggregate(F.transform(words, _kind), start, _step, found)


def _entries(numbers: Column, words: Column, of: str) -> Column:
    """Sources, names or references with their words in place of their numbers."""
    word = lambda i: F.get(words, i)
    or_none = lambda i: choose((i == _NO_WORD, ""), other=word(i))
    told = {"scope": lambda i: i, "cte": lambda i: i == 1, "of": or_none, "alias": or_none}
    if of == "sources":
        told["name"] = lambda i: choose((i == _DERIVED, _SUBQUERY), other=word(i))
    entry = lambda _, n: F.struct(*[told.get(f, word)(F.get(numbers, 3 * n + i)).alias(f) for i, f in enumerate(_ENTRIES[of])])
    return F.transform(F.slice(numbers, F.lit(1), (F.size(numbers) / 3).cast("int")), entry)


def _kind(t: Column) -> Column:
    """The kind of a word, told once, so that the fold compares numbers only."""
    single = {"(": OPEN, ")": CLOSE, ",": COMMA, ".": DOT, ";": SEMICOLON, "'": STRING, "::": CASTS}
    named = {
        SELECT: ("select",), FROM: ("from",), JOIN: ("join",), WITH: ("with",), AS: ("as",), ON: ("on", "using"), ORDER: ("order",), END: ("end",),
        UNION: ("union", "except", "intersect"), RECURSIVE: ("recursive",), OVER: ("over",), INTERVAL: ("interval",), WINDOW: ("window",),
        ENDS: ("where", "group", "having", "limit", "qualify", "offset", "fetch"),
    }
    out = F.when(t.rlike(r"^[^\p{L}\p{N}_]$|^::$"), _chosen(t, {k: (w,) for w, k in single.items()}, SIGN))
    out = out.when(t.isin(*KEYWORDS), _chosen(t, named, WORD)).when(t.rlike(r"^\d[\d.]*$"), NUMBER)
    types = tuple(x for x in LITERAL_TYPES if x != "interval")
    special = (*CAST_FUNCTIONS, "extract", *types, *WINDOW_WORDS)
    return out.when(t.isin(*special), _chosen(t, {CASTING: CAST_FUNCTIONS, EXTRACT: ("extract",), TYPE: types}, FRAME)).otherwise(IDENT)


def _chosen(t: Column, words: dict, other: int) -> Column:
    out = F.when(F.lit(False), 0)
    for kind, said in words.items():
        out = out.when(t.isin(*said), kind)
    return out.otherwise(other)


def _step(s: Column, k: Column) -> Column:
    """The state after a word. Each kind of words has a step of its own, which tells only what such a word may change."""
    return choose((k >= IDENT, _name_step(s, k)), (k > SIGN, _word_step(s, k)), (k > CLOSE, _sign_step(s, k)), other=_bracket_step(s, k))


def _after(s: Column, k: Column, **new: Column) -> Column:
    """The state with the fields that a word changes; of a dotted name ``prev2`` is the part before the dot."""
    new |= {"at": s["at"] + 1, "prev": s["at"], "k1": k, "prev2": choose(((s["k1"] == DOT) & (k != DOT), s["prev2"]), other=s["prev"])}
    return F.struct(*[(new[f].cast(x) if f in new else s[f]).alias(f) for f, x in _STATE.items()])


def _level(of: Column, **new) -> Column:
    return _struct(_LEVEL, *[new.get(f, of[f]) for f in ("scope", "root", "kind", "infrom", "src")])


def _added(entries: Column, *numbers) -> Column:
    return F.concat(entries, F.array(*[n if isinstance(n, Column) else F.lit(n) for n in numbers]))


def _without_last(entries: Column) -> Column:
    return F.slice(entries, F.lit(1), F.greatest(F.size(entries) - 3, F.lit(0)))


def _of_last(entries: Column, place: int) -> Column:
    return F.get(entries, F.size(entries) - 3 + place)


def _name_step(s: Column, k: Column) -> Column:
    k1, last = s["k1"], s["last"]
    kind, src = s["now"]["kind"], s["now"]["src"]
    windowed = (kind == OVER_WINDOW) | (kind == NAMED_WINDOW)
    named = lambda due: _named(s, k, due)
    windows = (k1 == WINDOW) | ((last == WINDOWS) & (k1 == COMMA))
    ended = (last == REF) | (last == NAME) | (k1 == CLOSE) | (k1 == STRING) | (k1 == END) | (k1 == NUMBER)
    # what a name is, the first that holds
    return choose(
        ((k == FRAME) & windowed, named(NOTHING)),
        (s["want"], named(CTE)),
        (k1 == DOT, choose((src == 3, named(REST)), other=named(COLUMN))),
        (kind == LIST, named(NAME)),
        ((last == SKIPPED) | (k1 == CASTS) | (k1 == OVER) | ((kind == CAST) & (k1 == AS)) | ((kind == FIELD) & (k1 == OPEN)), named(SKIPPED)),
        ((kind == QUERY) & (src == 1), named(SOURCE)),
        ((kind == QUERY) & (src == 2), named(ALIAS)),
        (windows, named(WINDOWS)),
        ((k1 == AS) | ((kind == QUERY) & ended), named(NAME)),
        other=named(REF),
    )


def _named(s: Column, k: Column, due: int) -> Column:
    now, sources, refs, at = s["now"], s["sources"], s["refs"], s["at"]
    scope = now["scope"]
    new = {"last": F.lit(REF if due == COLUMN else due), "want": F.lit(False)}
    if due == REF:
        new["refs"] = _added(refs, scope, _NO_WORD, at)
    if due == COLUMN:
        new["refs"] = choose((s["last"] == REF, _added(_without_last(refs), scope, s["prev2"], at)), other=refs)
    if due == SOURCE:
        new |= {"now": _level(now, src=2), "sources": _added(sources, scope, at, _NO_WORD)}
    if due == REST:
        new |= {"now": _level(now, src=2), "sources": _added(_without_last(sources), _of_last(sources, 0), at, _NO_WORD)}
    if due == ALIAS:
        new |= {"now": _level(now, src=0), "sources": _added(_without_last(sources), _of_last(sources, 0), _of_last(sources, 1), at)}
    if due in (CTE, NAME, WINDOWS):
        new["names"] = _added(s["names"], scope, int(due == CTE), at)
    return _after(s, k, **new)


def _word_step(s: Column, k: Column) -> Column:
    now, k1 = s["now"], s["k1"]
    scope, src = now["scope"], now["src"]
    depth = F.size(s["stack"])
    back = F.try_element_at(s["stack"], F.lit(-1))
    selects = k == SELECT
    nested = (selects | (k == WITH)) & (k1 == OPEN)
    beside = selects & (k1 != OPEN) & s["union"]
    grows = nested | beside
    new_scope = F.size(s["parents"])
    # a subquery that is a source, or declared by WITH, doesn't see the sources around it
    apart = (back["src"] == 1) | (s["with_depth"] == depth - 1)
    ends_from = (k == ENDS) | (k == ORDER) | (k == WINDOW) | (k == UNION)
    new_src = choose(((k == FROM) | (k == JOIN), 1), (ends_from | (k == ON), 0), other=src)
    new_now = choose(
        (nested, _struct(_LEVEL, new_scope, new_scope, QUERY, False, 0)),
        (beside, _struct(_LEVEL, new_scope, now["root"], QUERY, False, 0)),
        (selects, _struct(_LEVEL, scope, now["root"], QUERY, False, 0)),
        # an ORDER BY after UNION speaks of the first SELECT's columns
        (now["kind"] == QUERY, _level(now, scope=choose((k == ORDER, now["root"]), other=scope), infrom=~ends_from & ((k == FROM) | now["infrom"]), src=new_src)),
        other=now,
    )
    with_ = (k == WITH) & ((k1 == 0) | (k1 == OPEN) | (k1 == SEMICOLON))
    return _after(
        s, k,
        now=new_now,
        parents=choose((grows, F.concat(s["parents"], F.array(choose((nested, scope), other=F.get(s["parents"], scope))))), other=s["parents"]),
        outer=choose((grows, F.concat(s["outer"], F.array(choose((nested & ~apart, scope), other=F.get(s["outer"], scope))))), other=s["outer"]),
        last=choose((k == INTERVAL, UNIT), ((s["last"] == WINDOWS) & (k == AS), WINDOWS), other=NOTHING),
        with_depth=choose((with_, depth), (selects & (s["with_depth"] == depth), -1), other=s["with_depth"]),
        want=with_ | ((k == RECURSIVE) & s["want"]),
        union=(k == UNION) | (s["union"] & ~selects),
    )


def _sign_step(s: Column, k: Column) -> Column:
    now, last = s["now"], s["last"]
    src = now["src"]
    literal = (k == STRING) & (last == REF) & (s["k1"] == TYPE)
    new_src = choose(
        ((k == COMMA) & now["infrom"], 1), ((k == DOT) & (src == 2) & ((last == SOURCE) | (last == REST)), 3), other=src
    )
    return _after(
        s, k,
        now=choose(((now["kind"] == QUERY) & ((k == COMMA) | (k == DOT)), _level(now, src=new_src)), other=now),
        refs=choose((literal, _without_last(s["refs"])), other=s["refs"]),
        last=choose(
            # the unit of an interval is no name
            ((last == UNIT) & ((k == NUMBER) | (k == STRING)), SKIPPED),
            ((k == DOT) & ((last == REF) | (last == SOURCE) | (last == REST)), last),
            ((last == WINDOWS) & (k == COMMA), WINDOWS),
            other=NOTHING,
        ),
        want=(k == COMMA) & (s["with_depth"] == F.size(s["stack"])) & ~now["infrom"],
    )


def _bracket_step(s: Column, k: Column) -> Column:
    now, k1, last = s["now"], s["k1"], s["last"]
    scope, kind = now["scope"], now["kind"]
    in_select = kind == QUERY
    opens = k == OPEN
    back = F.try_element_at(s["stack"], F.lit(-1))
    sources = s["sources"]
    inner_kind = choose(
        (k1 == OVER, OVER_WINDOW),
        ((k1 == AS) & (last == WINDOWS), NAMED_WINDOW),
        (k1 == CASTING, CAST),
        (k1 == EXTRACT, FIELD),
        ((last == CTE) | (last == ALIAS), LIST),
        other=BRACKET,
    )
    opened = _after(
        s, k,
        now=_struct(_LEVEL, scope, scope, inner_kind, False, 0),
        stack=F.concat(s["stack"], F.array(now)),
        refs=choose((last == REF, _without_last(s["refs"])), other=s["refs"]),
        # a table function
        sources=choose((in_select & (now["src"] == 2) & (last == SOURCE), _added(_without_last(sources), _of_last(sources, 0), _DERIVED, _NO_WORD)), other=sources),
        last=F.lit(NOTHING),
        want=F.lit(False),
    )
    closed = _after(
        s, k,
        # what closed was the source that a FROM clause waited for
        now=choose((back["src"] == 1, _level(back, src=2)), other=back),
        stack=_all_but_last(s["stack"]),
        sources=choose(((back["src"] == 1) & in_select, _added(sources, back["scope"], _DERIVED, _NO_WORD)), other=sources),
        last=choose((kind == NAMED_WINDOW, WINDOWS), other=NOTHING),
        want=F.lit(False),
    )
    # a bracket that closes too often changes nothing
    return choose((opens, opened), (F.size(s["stack"]) > 0, closed), other=s.withField("at", s["at"] + 1))


def with_unresolved(df: DataFrame, sql: str = "generated", ddl: str = "ddl") -> DataFrame:
    """Add ``unresolved``: the unknown names as (kind 'table' or 'column', name), and ``tables``.

    Names count in the scope of their SELECT and in those nested in it: sources and their aliases, names declared by WITH or
    WINDOW, and the names a SELECT gives its columns. Where a source is unknown, a subquery or declared by WITH, loose column names
    may be its own and are not counted against the statement.
    """
    df = with_tables(df, ddl)
    df = settled(df.withColumn("_words", _words_of(F.coalesce(F.col(sql), F.lit("")))), "_words")
    df = settled(df.withColumn("_read", _read(F.col("_words"))), "_read")
    df = df.withColumns({f"_{f}": F.col(f"_read.{f}") for f in ("parents", "outer", "sources", "names", "refs")}).drop("_read", "_words")

    def chains(up: str) -> Column:
        """Each scope with those around it."""
        return F.transform(
            up,
            lambda p, i: F.aggregate(
                up, F.array(i), lambda chain, _: F.when(F.element_at(chain, -1) < 0, chain).otherwise(F.concat(chain, F.array(F.get(up, F.element_at(chain, -1)))))
            ),
        )

    df = df.withColumns({"_around": chains("_parents"), "_view": chains("_outer")}).drop("_outer")
    df = settled(df, "_around", "_view", "_sources", "_names", "_refs", "_parents")

    def seen_from(scope: Column, source: Column) -> Column:
        return F.exists(F.get("_view", scope), lambda x: x == source["scope"])

    def declared(source: Column) -> Column:
        return F.exists("_names", lambda n: n["cte"] & (n["name"] == source["name"]) & F.exists(F.get("_around", source["scope"]), lambda x: x == n["scope"]))

    # of each source: its columns, null where they aren't known
    sources = F.transform(
        "_sources",
        lambda s: F.struct(
            s["scope"].alias("scope"),
            s["name"].alias("name"),
            s["alias"].alias("alias"),
            (s["name"] == _SUBQUERY).alias("derived"),
            declared(s).alias("declared"),
            F.when(
                (s["name"] != _SUBQUERY) & ~declared(s),
                first(F.transform(F.filter("tables", lambda t: t["key"] == s["name"]), lambda t: F.transform(t["cols"], lambda c: c["key"]))),
            ).alias("cols"),
        ),
    )
    df = settled(df.withColumn("_known", sources), "_known")
    unknown = F.array_distinct(
        F.transform(F.filter("_known", lambda s: s["cols"].isNull() & ~s["derived"] & ~s["declared"]), lambda s: s["name"])
    )

    def behind(r: Column) -> Column:
        """Sources that a reference's qualifier may mean."""
        return F.filter("_known", lambda s: seen_from(r["scope"], s) & ((s["alias"] == r["of"]) | (s["name"] == r["of"])))

    strange = F.filter("_refs", lambda r: (r["of"] != "") & (F.size(behind(r)) == 0))
    missing = F.filter(
        "_refs",
        lambda r: (r["of"] != "") & (F.size(behind(r)) > 0) & F.forall(behind(r), lambda s: s["cols"].isNotNull() & ~F.exists(s["cols"], lambda c: c == r["col"])),
    )
    same_level = lambda r, n: (n["scope"] == r["scope"]) | (F.get("_parents", n["scope"]) == F.get("_parents", r["scope"]))
    loose = F.filter(
        "_refs",
        lambda r: (r["of"] == "")
        & ~F.exists("_known", lambda s: seen_from(r["scope"], s) & (s["cols"].isNull() | F.exists(s["cols"], lambda c: c == r["col"]) | (s["alias"] == r["col"]) | (s["name"] == r["col"])))
        & ~F.exists("_names", lambda n: ~n["cte"] & (n["name"] == r["col"]) & same_level(r, n)),
    )

    def of_kind(kind: str, items: Column) -> Column:
        return F.transform(items, lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("name")))

    found = F.concat(
        of_kind("table", unknown),
        of_kind("table", F.transform(strange, lambda r: r["of"])),
        of_kind("column", F.transform(missing, lambda r: r["col"])),
        of_kind("column", F.transform(loose, lambda r: r["col"])),
    )
    done = df.withColumn("unresolved", F.array_distinct(found))
    return settled(done.drop(*[c for c in done.columns if c.startswith("_")]), "unresolved")


def resolvability(preds: DataFrame) -> DataFrame:
    """Share of statements per label whose names all exist. Needs ``label``, ``generated`` and ``ddl``."""
    return (
        with_unresolved(preds.select("label", "generated", "ddl"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_statements"), rate(F.size("unresolved") == 0).alias("resolvability_rate"))
    )


def hallucination(preds: DataFrame) -> DataFrame:
    """Share of statements per label with an unknown name, in all and by kind."""
    kind = lambda k: F.exists("unresolved", lambda u: u["kind"] == k)
    return (
        with_unresolved(preds.select("label", "generated", "ddl"))
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n_statements"),
            rate(F.size("unresolved") > 0).alias("hallucination_rate"),
            rate(kind("table")).alias("table_rate"),
            rate(kind("column")).alias("column_rate"),
        )
    )
