"""Scores of predictions (row_id, label, generated, reference, latency_ms) per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from qloom.functions.numbers import exact, mean
from qloom.functions.text import contains_all, contains_any, is_match
from qloom.operators.bleu import bleu_counts, bleu_score
from qloom.operators.joins import join_null_safe
from qloom.operators.selection import rank_percentiles


def rate(flag: Column) -> Column:
    return F.count_if(flag) / F.count(F.lit(1))


def exact_match(preds: DataFrame) -> DataFrame:
    """Share of exact matches per label; rows without a reference are counted apart."""
    scored = F.col("reference").isNotNull()
    hit = scored & is_match(F.col("generated"), F.col("reference"))
    n = F.count_if(scored)
    return preds.groupBy("label").agg(
        n.alias("n_samples"),
        F.count_if(~scored).alias("n_skipped"),
        F.when(n > 0, F.count_if(hit) / n).alias("exact_match_accuracy"),
    )


def latency(df: DataFrame, by: Sequence[str], col: str, approximate: bool = False) -> DataFrame:
    """Average, middle and 95 % position of a latency column per group."""
    # one narrow exchange that all passes share, so that what lies below runs once
    rows = df.select(*by, col).hint("rebalance")
    averages = rows.groupBy(*by).agg(
        F.count(col).alias("n_samples"), mean(exact(col, 6, 24)).alias("avg_latency_ms")
    )
    places = rank_percentiles(rows, by, col, {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}, approximate)
    if by:
        return join_null_safe(averages, places, by, "left")
    # two sides of one row each
    return averages.select("*", *[places.select(c).scalar().alias(c) for c in places.columns])


def report(preds: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """One row per label, the missing label too, with all scores; a label without references has no text scores.

    ``resolved`` holds ``label`` and ``resolvability_rate`` where the statements were checked against
    their table definitions.
    """
    # one pass over the texts gives both the exact matches and the n-gram counts
    texts = bleu_counts(preds).select(
        "label",
        "n_samples",
        "n_skipped",
        F.when(F.col("n_samples") > 0, F.col("matches") / F.col("n_samples")).alias("exact_match_accuracy"),
        bleu_score().alias("bleu4"),
    )
    out = join_null_safe(texts, latency(preds, ["label"], "latency_ms").drop("n_samples"), ["label"])
    return out if resolved is None else join_null_safe(out, resolved, ["label"], "left")


METRICS = ("exact_match_accuracy", "resolvability_rate", "bleu4")


def delta(scores: DataFrame, better: str, base: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """One row: each metric of label ``better`` less that of label ``base``.

    Without a list, all of METRICS that the report has.
    """

    def of(label: str, metric: str) -> Column:
        return F.max(F.when(F.col("label") == label, F.col(metric)))

    metrics = metrics or [m for m in METRICS if m in scores.columns]
    return scores.where(F.col("label").isin(better, base)).agg(
        *[(of(better, m) - of(base, m)).alias(f"delta_{m}") for m in metrics]
    )


def token_checks(df: DataFrame, col: str, wanted: Sequence[str], unwanted: Sequence[str] = ()) -> DataFrame:
    """Whether a text has all wanted tokens (any case) and none of the unwanted ones (case kept)."""
    has_all = contains_all(F.col(col), F.array(*map(F.lit, wanted)))
    has_bad = contains_any(F.col(col), F.array(*map(F.lit, unwanted))) if unwanted else F.lit(False)
    return df.withColumns({"has_all": has_all, "has_unwanted": has_bad, "passed": has_all & ~has_bad})


def suite_summary(checks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Passed, failed, percent, and a tier from the marks 95 and 80."""
    percent = rate(F.col("passed")) * 100
    return (
        checks.groupBy(*by)
        .agg(
            F.count_if("passed").alias("n_passed"),
            F.count_if(~F.col("passed")).alias("n_failed"),
            percent.alias("percent"),
        )
        .withColumn("tier", F.when(F.col("percent") >= 95, "good").when(F.col("percent") >= 80, "fair").otherwise("poor"))
    )
