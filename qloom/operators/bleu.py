"""Corpus BLEU-4 with the usual public rules (Papineni et al. 2002; Post 2018)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.text import is_match, rstrip, words

ORDERS = (1, 2, 3, 4)

# The "13a" tokenisation, as ordered (pattern, replacement) pairs.
REMOVED = ("<skipped>", "-\n")
ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
SPLITS = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)
# End of fixed values.


def tokens(col: Column) -> Column:
    """Words and punctuation marks of a text, case kept."""
    text = rstrip(col)
    for mark in REMOVED:
        text = F.replace(text, F.lit(mark), F.lit(""))
    text = F.replace(text, F.lit("\n"), F.lit(" "))
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in SPLITS:
        text = F.regexp_replace(text, pattern, replacement)
    return words(text)


def _hashed(toks: Column) -> Column:
    """Tokens as 64-bit numbers, so that sorting and set operations on n-grams compare numbers and not texts."""
    return F.transform(toks, lambda t: F.xxhash64(t))


def _longer(grams: Column, toks: Column, n: int) -> Column:
    """The n-grams that extend (n-1)-grams by one token each."""
    many = F.greatest(F.size(toks) - (n - 1), F.lit(0))
    return F.zip_with(F.slice(grams, F.lit(1), many), F.slice(toks, F.lit(n), many), lambda g, t: F.xxhash64(g, t))


def _numbered(grams: Column) -> Column:
    """The same entries with repeats told apart: the second "a" becomes the hash of "a" and 2.

    Equal entries meet by sorting. The one-element arrays name an intermediate result, so that it is
    worked out once and not inside the inner loops.
    """

    def runs(ordered: Column) -> Column:
        first_of_run = lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), first_of_run)

        def entries(start: Column, stop: Column) -> Column:
            gram = F.get(ordered, start)
            return F.transform(
                F.sequence(F.lit(1), stop - start),
                lambda k: F.when(k == 1, gram).otherwise(F.xxhash64(gram, k)),
            )

        ends = lambda s: F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(F.size(ordered)))
        return F.flatten(F.transform(F.array(starts), lambda s: F.flatten(F.zip_with(s, ends(s), entries))))

    return F.flatten(F.transform(F.array(F.sort_array(grams)), runs))


def _clipped_matches(ours: Column, theirs: Column) -> Column:
    """How many n-grams two texts have in common, each counted as often as in the text with fewer of it.

    For equal texts that is all of them, and where one side repeats nothing the plain intersection.
    """
    no_repeats = lambda g: F.size(F.array_distinct(g)) == F.size(g)
    return (
        F.when(ours == theirs, F.size(ours))
        .when(no_repeats(ours) | no_repeats(theirs), F.size(F.array_intersect(ours, theirs)))
        .otherwise(F.size(F.array_intersect(_numbered(ours), _numbered(theirs))))
    )


def bleu_counts(preds: DataFrame) -> DataFrame:
    """Per label: samples, rows skipped, exact matches, clipped n-gram matches ``m<n>``, totals ``t<n>``, and both lengths.

    Matches are clipped within a prediction, so each row is counted by itself and only these counts are
    shuffled. Rows without a reference are skipped: they count as such and have no tokens.
    """
    scored = F.col("reference").isNotNull()
    df = preds.select(
        "label",
        scored.alias("scored"),
        _hashed(tokens(F.when(scored, F.coalesce("generated", F.lit(""))).otherwise(""))).alias("h1"),
        _hashed(tokens(F.coalesce("reference", F.lit("")))).alias("r1"),
        (scored & is_match(F.col("generated"), F.col("reference"))).alias("same"),
    )
    for n in ORDERS[1:]:
        df = df.withColumns({f"{side}{n}": _longer(F.col(f"{side}{n - 1}"), F.col(f"{side}1"), n) for side in "hr"})
    counted = df.select(
        "label",
        "scored",
        "same",
        *[_clipped_matches(F.col(f"h{n}"), F.col(f"r{n}")).alias(f"m{n}") for n in ORDERS],
        *[F.size(f"h{n}").alias(f"t{n}") for n in ORDERS],
        F.size("r1").alias("ref_len"),
    )
    return counted.groupBy("label").agg(
        F.count_if("scored").alias("n_samples"),
        F.count_if(~F.col("scored")).alias("n_skipped"),
        F.count_if("same").alias("matches"),
        *[F.sum(f"m{n}").alias(f"m{n}") for n in ORDERS],
        *[F.sum(f"t{n}").alias(f"t{n}") for n in ORDERS],
        F.sum("t1").alias("hyp_len"),
        F.sum("ref_len").alias("ref_len"),
    )


def bleu_score() -> Column:
    """Score from 0 to 100 out of the counts: exponential smoothing, effective order; null without a sample."""
    logs, zeros = [], F.lit(0)
    for n in ORDERS:
        match, total = F.col(f"m{n}"), F.col(f"t{n}")
        zeros = zeros + F.when((match == 0) & (total > 0), 1).otherwise(0)
        hits = F.when(match > 0, match.cast("double")).otherwise(1 / F.pow(F.lit(2.0), zeros))
        logs.append(F.when(total > 0, F.log(100 * hits / total)).otherwise(0.0))
    order = reduce(add, [F.when(F.col(f"t{n}") > 0, 1).otherwise(0) for n in ORDERS])
    brevity = F.when(
        F.col("hyp_len") < F.col("ref_len"), F.exp(1 - F.col("ref_len") / F.col("hyp_len"))
    ).otherwise(1.0)
    any_match = reduce(add, [F.col(f"m{n}") for n in ORDERS]) > 0
    score = F.when(any_match, brevity * F.exp(reduce(add, logs) / order)).otherwise(0.0)
    return F.when(F.col("n_samples") > 0, score)


def bleu4(preds: DataFrame) -> DataFrame:
    """Corpus BLEU-4 per label."""
    return bleu_counts(preds).select("label", bleu_score().alias("bleu4"))
