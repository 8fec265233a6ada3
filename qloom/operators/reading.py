"""Reading of a question's numbers, years and status words by one fold over its words.

The fold keeps what is open at a word: a comparison waiting for its number, an interval waiting for its ends, a year
bound, and how many words a negation still reaches. It runs inside the row, so reading needs no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from qloom.functions.stages import choose

# The words and phrases that open something.
ABOVE_PHRASES = ("over", "above", r"greater\s+than", r"higher\s+than", r"more\s+than", "exceeding")
BELOW_PHRASES = ("below", "under", r"less\s+than", r"lower\s+than", r"fewer\s+than")
AT_LEAST_PHRASES = (r"at\s+least", r"(?:no|not)\s+(?:less|lower|fewer)\s+than", r"(?:not|never)\s+(?:below|under)")
AT_MOST_PHRASES = (r"at\s+most", r"up\s+to", r"(?:no|not)\s+(?:more|higher|greater)\s+than", r"(?:not|never)\s+(?:over|above|exceeding)")
INTERVAL_WORDS = ("between",)
NEGATION_WORDS = (
    "not", "isn't", "aren't", "wasn't", "weren't", "isnt", "arent", "wasnt", "werent", "non", "except", "excluding", "without",
)
LIMIT_WORDS = ("top", "first", "limit", "leading")
# how a word before a year bounds it
YEAR_BOUNDS = {
    "before": "<", "after": ">", "since": ">=", "from": ">=", "until": "<=", "till": "<=", "through": "<=", "to": "<=",
}
# End of fixed values.

YEAR = r"(?:19|20)\d{2}"
NUMBER = r"\d+(?:\.\d+)?"
# words that a negation reaches, and words that may stand between a bound and its year
_REACH = 3
_BOUND_REACH = 2
_TOKEN = rf"[<>]=?|{NUMBER}(?![\p{{L}}\p{{N}}_])|[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_'’-]*|[.;?!,]"

# kinds of tokens; those from ODD on are words, and an odd one (with a hyphen, or a digit first) names no column
NUM, YEAR_NUM, SIGN, STOP, COMMA = 1, 2, 3, 4, 5
ODD, WORD, OPENS, NEGATES, NOT, STATUS, BOUND, TO, LIMIT, THE, IS, IN, OF, AND = range(9, 23)

_COMPARISON = "struct<col:string,op:string,value:decimal(18,4),number:string>"
_STATE = {
    "prev": "string", "kind": "int", "prev2": "string", "kind2": "int", "col": "string", "op": "string", "ends": "int", "low": "string",
    "low_year": "boolean", "bound": "string", "bound_left": "int", "neg": "int", "found": f"array<{_COMPARISON}>",
    "years": "array<struct<op:string,year:int>>", "statuses": "array<struct<word:string,negated:boolean>>", "taken": "array<struct<at:int,n:int>>",
}


def plain_numbers(text: Column) -> Column:
    """Numbers without currency signs and separators of thousands: "$1,000" becomes "1000"."""
    text = F.regexp_replace(text, r"[$€£¥]\s?(?=\d)", "")
    return F.regexp_replace(text, r"(?<=(?<![\d.])\d{1,3}|,\d{3}),(?=\d{3}(?!\d))", "")


def _marked(text: Column) -> Column:
    """Phrases of comparison before a number become signs."""
    for phrases, sign in ((AT_LEAST_PHRASES, ">="), (AT_MOST_PHRASES, "<="), (ABOVE_PHRASES, ">"), (BELOW_PHRASES, "<")):
        text = F.regexp_replace(text, rf"(?<!\w)(?:{'|'.join(phrases)})\s+(?={NUMBER})", f" {sign} ")
    return text


def _kind(t: Column, status_words: tuple[str, ...]) -> Column:
    """The kind of a token, told once, so that the fold compares numbers only."""
    negating = tuple(w for w in NEGATION_WORDS if w != "not")
    return choose(
        (t.rlike(r"^\d+(?:\.\d+)?$"), choose((t.rlike(f"^{YEAR}$"), YEAR_NUM), other=NUM)),
        (t.isin("<", ">", "<=", ">="), SIGN),
        (t.isin(".", ";", "?", "!"), STOP),
        (t == ",", COMMA),
        (t.isin(*status_words), STATUS),
        (t.isin(*negating), NEGATES),
        (t.isin(*(w for w in YEAR_BOUNDS if w != "to")), BOUND),
        (t.isin(*LIMIT_WORDS), LIMIT),
        (t.isin(*INTERVAL_WORDS), OPENS),
        (
            t.isin("not", "to", "the", "is", "in", "during", "of", "and"),
            choose((t == "not", NOT), (t == "to", TO), (t == "the", THE), (t == "is", IS), (t == "of", OF), (t == "and", AND), other=IN),
        ),
        (t.rlike(r"^\D\w*$"), WORD),
        other=ODD,
    )


def read_words(text: Column, names: Column, status_words: tuple[str, ...]) -> Column:
    """What a lower-case question says, as struct(found, years, statuses, words).

    found: comparisons (col, op, value, number), col being the word before, which need not be a column;
    years: (op, year) in the order of the text; statuses: (word, negated); words: all words but those of comparisons.
    A number that is compared, or that says how many rows are wanted, is no year; two years between which something lies are
    bounds, unless the word before is one of ``names``.
    """
    raw = F.regexp_extract_all(_marked(text), F.lit(_TOKEN), F.lit(0))
    tokens = F.transform(raw, lambda t, i: F.struct(t.alias("t"), _kind(t, status_words).alias("k"), i.alias("at")))
    none = {"string": F.lit(""), "int": F.lit(0), "boolean": F.lit(False)}
    start = F.struct(*[none.get(kind, F.array()).cast(kind).alias(f) for f, kind in _STATE.items()])

    def told(tokens: Column, s: Column) -> Column:
        return F.struct(*[s[f].alias(f) for f in ("found", "years", "statuses")], _words_left(tokens, s["taken"]).alias("words"))

    # the one-element array names the tokens; the results are picked inside the fold, as each pick from outside would write the fold again
    read = F.transform(
        F.array(tokens), lambda ts: F.aggregate(ts, start, lambda s, t: _step(s, t["t"], t["k"], t["at"], names), lambda s: told(ts, s))
    )
    return F.get(read, F.lit(0))


def _words_left(tokens: Column, taken: Column) -> Column:
    """The words in their order, without those that comparisons took: at each place, so many of the words left before it."""

    def without(left: Column, gone: Column) -> Column:
        before = F.filter(left, lambda t: t["at"] < gone["at"])
        kept = F.slice(before, F.lit(1), F.greatest(F.size(before) - gone["n"], F.lit(0)))
        return F.flatten(F.array(kept, F.filter(left, lambda t: t["at"] > gone["at"])))

    said = F.filter(tokens, lambda t: (t["k"] >= ODD) & (t["k"] != OPENS))
    return F.transform(F.aggregate(taken, said, without), lambda t: t["t"])


def _comparison(col: Column, op, number: Column) -> Column:
    op = op if isinstance(op, Column) else F.lit(op)
    return F.struct(col.alias("col"), op.alias("op"), number.try_cast("decimal(18,4)").alias("value"), number.alias("number"))


def _years(*pairs) -> Column:
    made = [F.struct((op if isinstance(op, Column) else F.lit(op)).alias("op"), y.try_cast("int").alias("year")) for op, y in pairs]
    return F.array(*made)


def _step(s: Column, t: Column, k: Column, at: Column, names: Column) -> Column:
    k1, k2, found = s["kind"], s["kind2"], s["found"]
    number, word = k <= YEAR_NUM, k >= ODD
    opening = (k == SIGN) | (k == OPENS)
    # the word that a comparison is about stands before it, or before its "is"
    about = choose((k1 == IS, choose((k2 >= WORD, s["prev2"]), other="")), (k1 >= WORD, s["prev"]), other="")
    compared = number & (s["op"] != "")
    free = number & (s["op"] == "")
    closes = free & (s["ends"] == 1)
    in_years = (k == YEAR_NUM) & s["low_year"] & ~F.array_contains(names, s["col"])
    dated = (k == YEAR_NUM) & free & (s["ends"] == 0) & (k1 != LIMIT) & ~((k1 == THE) & (k2 == LIMIT))
    bound = choose((s["bound_left"] > 0, s["bound"]), ((k1 == IN) & (k2 == NOT), "<>"), other="=")
    # a comparison about no column is about the column named right behind its number: "over 5 minutes"
    said = F.try_element_at(found, F.lit(-1))
    unit = word & (k1 <= YEAR_NUM) & (F.size(found) > 0) & (said["number"] == s["prev"]) & F.array_contains(names, t) & ~F.array_contains(names, said["col"])
    all_but_last = lambda items: F.slice(items, F.lit(1), F.size(items) - 1)
    bounds = choose(*((t == said_word, op) for said_word, op in YEAR_BOUNDS.items()), other="")
    # "from 2019 to 2021": "to" bounds only what follows a number
    is_bound = (k == BOUND) | ((k == TO) & (k1 >= NUM) & (k1 <= YEAR_NUM))
    taken = F.struct(at.alias("at"), choose((k1 == IS, 2), other=1).alias("n"))
    moved = {"prev": t, "kind": k, "prev2": s["prev"], "kind2": k1}
    new = moved | {
        "col": choose((opening, about), other=s["col"]),
        "op": choose((k == SIGN, t), (number | (k == STOP), ""), other=s["op"]),
        # only "and" or "to" may stand between the ends of an interval, and nothing before them
        "ends": choose(
            (k == OPENS, 2),
            (s["ends"] == 0, 0),
            (number, choose((compared, s["ends"]), other=s["ends"] - 1)),
            ((s["ends"] == 1) & ((k == AND) | (k == TO)), 1),
            other=0,
        ),
        "low": choose((number & (s["ends"] == 2), t), other=s["low"]),
        "low_year": choose((number & (s["ends"] == 2), k == YEAR_NUM), other=s["low_year"]),
        "bound": choose((is_bound, bounds), other=s["bound"]),
        "bound_left": choose(
            (is_bound, _BOUND_REACH), ((s["bound_left"] == 0) | (k < ODD) | (k == IN) | (k == OF), 0), other=s["bound_left"] - 1
        ),
        "neg": choose(
            ((k == NOT) | (k == NEGATES), _REACH),
            ((s["neg"] == 0) | (k == STOP) | (k == COMMA) | (k == STATUS), 0),
            (word, s["neg"] - 1),
            other=s["neg"],
        ),
        "found": choose(
            (compared, F.concat(found, F.array(_comparison(s["col"], s["op"], t)))),
            (closes & ~in_years, F.concat(found, F.array(_comparison(s["col"], ">=", s["low"]), _comparison(s["col"], "<=", t)))),
            (unit, F.concat(all_but_last(found), F.array(_comparison(t, said["op"], said["number"])))),
            other=found,
        ),
        "years": choose(
            (closes & in_years, F.concat(s["years"], _years((">=", s["low"]), ("<=", t)))),
            (dated, F.concat(s["years"], _years((bound, t)))),
            other=s["years"],
        ),
        "statuses": choose(
            (k == STATUS, F.concat(s["statuses"], F.array(F.struct(t.alias("word"), (s["neg"] > 0).alias("negated"))))), other=s["statuses"]
        ),
        # the word a comparison is about goes with it
        "taken": choose((opening & (about != ""), F.concat(s["taken"], F.array(taken))), other=s["taken"]),
    }
    # a word that opens nothing and meets nothing open only moves the place
    plain = ((k == ODD) | (k == WORD) | (k >= TO)) & (k1 > YEAR_NUM) & (s["ends"] == 0) & (s["bound_left"] == 0) & (s["neg"] == 0)
    state = lambda values: F.struct(*[values.get(f, s[f]).cast(kind).alias(f) for f, kind in _STATE.items()])
    return choose((plain, state(moved)), other=state(new))
