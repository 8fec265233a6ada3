"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule votes good (1), bad (-1) or abstains (0) on a document. Documents are counted by vote pattern, at
most 3 ** len(RULES) of them whatever the input, and EM over the counted patterns estimates how often each
rule gives each vote on good and on bad documents. The posterior that a document is good decides; no single
rule rejects one, apart from the base limits.

Null and empty texts have no words and fail the base. Rows are judged one by one, so ties, repeated rows and
null ids change nothing; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from qloom.llm.shared import cut, shared_folder, words_of
from qloom.sources.tables import scan

WINDOW = 8
MIN_WORDS = 20
# documents less likely good than this are rejected: four times likelier bad than good
THRESHOLD = 0.2
SYMBOLS = "#*$%&|<>"
END_MARKS = tuple(".!?…\"'”»:;")

FEATURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_ended_lines n_distinct n_same_next "
    "n_letter_words n_symbol_words"
).split()
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: list[bytes]) -> int:
    """Words lying in a window of eight words that the text holds twice or more.

    Windows are named exactly by doubling: the names of two halves are ranked to the name of the whole.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    name = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    span = 1
    while span < WINDOW:
        pair = name[:-span] * (n + 1) + name[span:]
        _, name = np.unique(pair, return_inverse=True)
        span *= 2
    repeated = np.flatnonzero(np.bincount(name)[name] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, repeated, 1)
    np.add.at(edges, repeated + WINDOW, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The features of one text, in the order of FEATURES."""
    words = words_of(text)
    if not words:
        return (0,) * len(FEATURES)
    lines = [x for x in text.split("\n") if x.encode().split()]
    last = {w for w in set(words) if w[-1:] in b"#*$%&|<>"}
    bare = {w for w in set(words) if not any(c.isalpha() for c in w.decode())}
    return (
        len(words),
        len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r"),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        len(lines),
        sum(x.rstrip().endswith(END_MARKS) for x in lines),
        len(set(words)),
        sum(a == b for a, b in zip(words, words[1:])),
        len(words) - (sum(w in bare for w in words) if bare else 0),
        sum(w in last for w in words) if last else 0,
    )


@F.pandas_udf(StructType([StructField(name, LongType()) for name in FEATURES]))
def _features(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(x) for x in texts], columns=FEATURES, dtype="int64")


def features(text: Column) -> Column:
    # said to be nondeterministic, else a filter on it would have every text measured twice
    return _features.asNondeterministic()(text)


def base_failed(f: Column) -> Column:
    return (f.n_words < MIN_WORDS) | (100 * f.n_repeat_words > 30 * f.n_words)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _above(percent: int) -> Callable[[Column, Column], Column]:
    return lambda part, whole: part * 100 > whole * percent


def _below(percent: int) -> Callable[[Column, Column], Column]:
    return lambda part, whole: part * 100 < whole * percent


def _share(part: str, whole: str, bad: Callable, good: Callable) -> Callable[[Column], Column]:
    """A rule on the share part / whole, compared as products so that nothing is divided by zero."""
    return lambda f: _vote(bad(f[part], f[whole]), good(f[part], f[whole]))


# chance of (bad, none, good) votes on a bad and on a good document before any data is seen
_ON_BAD, _ON_GOOD = (0.5, 0.1, 0.4), (0.01, 0.14, 0.85)

RULES: dict[str, Callable[[Column], Column]] = {
    "word_length": lambda f: _vote(
        (f.word_chars < 2 * f.n_words) | (f.word_chars > 15 * f.n_words),
        (2 * f.word_chars >= 5 * f.n_words) & (f.word_chars <= 12 * f.n_words),
    ),
    "symbols": _share("n_symbols", "n_words", _above(15), _below(3)),
    "symbol_words": _share("n_symbol_words", "n_words", _above(10), _below(2)),
    "letters": _share("n_letter_words", "n_words", _below(75), _above(90)),
    "line_ends": _share("n_ended_lines", "n_lines", _below(30), _above(65)),
    "repeated_windows": _share("n_repeat_words", "n_words", _above(30), _below(5)),
    "repeated_lines": _share("n_dup_lines", "n_lines", _above(30), _below(5)),
    "repeated_next": _share("n_same_next", "n_words", _above(15), _below(4)),
    "few_distinct": _share("n_distinct", "n_words", _below(12), _above(25)),
}


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, strength: float = 50.0) -> tuple[float, np.ndarray]:
    """(share of good documents, chance[class, rule, vote + 1]) by EM over counted vote patterns.

    The chances held before any data weigh as much as ``strength`` documents of each class, so that few
    documents leave them almost as they are.
    """
    before = np.array([[_ON_BAD] * len(RULES), [_ON_GOOD] * len(RULES)])
    chance, good = before, 0.8
    if not len(counts):
        return good, chance
    votes = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    for _ in range(rounds):
        logs = np.einsum("prv,crv->pc", votes, np.log(chance)) + np.log([1 - good, good])
        logs -= logs.max(axis=1, keepdims=True)
        post = np.exp(logs)
        post /= post.sum(axis=1, keepdims=True)
        seen = post * counts[:, None]
        chance = np.einsum("pc,prv->crv", seen, votes) + strength * before
        chance /= chance.sum(axis=2, keepdims=True)
        good = (seen[:, 1].sum() + 0.8 * strength) / (counts.sum() + strength)
    return float(good), chance


def _voted(docs: DataFrame, text: str) -> DataFrame:
    """One row per document: the input row, its features, its votes."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), features(F.col(f"`{text}`")).alias("f"))
    return whole.withColumn("votes", F.array(*[v.cast("int") for v in (rule(F.col("f")) for rule in RULES.values())]))


def posterior(voted: DataFrame, good: float, chance: np.ndarray) -> Column:
    """The chance that a document is good, from its votes."""
    odds = np.log(chance[1] / chance[0])
    total = F.lit(float(np.log(good / (1 - good))))
    for r in range(len(RULES)):
        v = F.col("votes")[r]
        total = total + F.when(v == -1, float(odds[r, 0])).when(v == 0, float(odds[r, 1])).otherwise(float(odds[r, 2]))
    return 1 / (1 + F.exp(-total))


def _model(voted: DataFrame) -> tuple[float, np.ndarray]:
    # shares say little about a handful of words; texts that fail the base by their repeats do teach the rules
    rows = voted.where(F.col("f.n_words") >= MIN_WORDS).groupBy("votes").count().collect()
    rows.sort(key=lambda r: r["votes"])
    return fit(np.array([r["votes"] for r in rows]).reshape(-1, len(RULES)), np.array([r["count"] for r in rows], float))


def judge(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the columns in ``keep``, the base features, base_failed, probability, kept."""
    voted = cut(_voted(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]), text).withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in keep])))
    probability = posterior(voted, *_model(voted))
    failed = base_failed(F.col("f"))
    return voted.select(
        *[F.col(f"row.`{c}`") for c in keep],
        *[F.col(f"f.{c}") for c in BASE],
        failed.alias("base_failed"),
        probability.alias("probability"),
        (~failed & (probability >= threshold)).alias("kept"),
    )


def filter_documents(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the base and the posterior keep, unchanged.

    Texts are measured once: rows, features and votes go to a table in the shared folder, of which the model reads the votes alone.
    """
    folder = shared_folder(docs.sparkSession, "quality-votes")
    _voted(docs, text).write.parquet(folder)
    voted = docs.sparkSession.read.parquet(folder)
    kept = ~base_failed(F.col("f")) & (posterior(voted, *_model(voted)) >= threshold)
    return voted.where(kept).select("row.*").select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in docs.schema])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(scan(spark, sf_dir, "documents"))


QUERIES = {"op8_quality_rules": query}
