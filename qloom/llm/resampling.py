"""Quality selection by importance resampling of hashed n-grams.

Words are lower-cased (A-Z) and cut at ASCII white space; words and pairs of words are hashed into ``buckets``. Two bag models,
of a target (labelled good texts) and of the raw texts (all of them), give each document the weight

    log w = sum over its n-grams of log p_target(bucket) - log p_raw(bucket)

and the sample without replacement is the ``k`` documents with the largest log w + g, where g is a Gumbel number made from the
hash of id and text, so that a rerun draws the same sample.

The target model may be made from at most ``target_rows`` labelled good documents, those with the smallest hash of
their id; the raw model counts all documents. ``k`` is a share of all documents; by default the share of good ones among the
labelled. With no good label at all every weight is zero and the sample is uniform; with no label all rows are taken.

Null and empty texts have no n-grams and weight zero. Rows with the same id and text draw the same number and are
ranked side by side; null ids draw by their text. Very long texts are read whole. An empty table gives an empty sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import boxed, cut, ranked, unboxed
from qloom.sources.tables import scan

BUCKETS = 1 << 16
TARGET_ROWS = 20_000
# words remembered per task
KNOWN = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """Buckets of a text's words and word pairs."""

    def __init__(self, buckets: int):
        self.buckets = np.uint64(buckets)
        self.known: dict[bytes, int] = {}

    def _learn(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self.known) < KNOWN:
            self.known[word] = value
        return value

    def grams(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if isinstance(text, str) else []
        if not words:
            return np.zeros(0, np.int64)
        get, learn = self.known.get, self._learn
        one = np.fromiter((get(w) or learn(w) for w in words), np.uint64, len(words))
        two = (one[:-1] * _MIX) ^ (one[1:] >> np.uint64(1))
        two = (two ^ (two >> np.uint64(31))) * _MIX
        return np.concatenate([one % self.buckets, (two >> np.uint64(8)) % self.buckets]).astype(np.int64)


def _count(buckets: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(buckets)
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for f in frames:
            for text, good in zip(f["text"], f["good"]):
                grams = hasher.grams(text)
                np.add.at(raw, grams, 1)
                if good:
                    np.add.at(target, grams, 1)
        seen = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})

    return run


def log_ratio(raw: np.ndarray, target: np.ndarray, smoothing: float = 0.005) -> np.ndarray:
    """log p_target - log p_raw for each bucket, the target mixed with a small share of the raw model; zeros where there is no target."""
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    q = raw / raw.sum()
    p = (target / target.sum() + smoothing * q) / (1 + smoothing)
    return np.log(np.where(raw > 0, p, 1.0)) - np.log(np.where(raw > 0, q, 1.0))


def weighted(docs: DataFrame, good_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, target_rows: int = TARGET_ROWS, seed: int = 42) -> DataFrame:
    """One row per document: id, log_weight (long grams summed), n_grams, gumbel_key."""
    own = docs.select(boxed(F.col(f"`{doc_id}`")).alias("id"), F.col(f"`{text}`").alias("text"))
    picked = good_ids.toDF("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(target_rows)
    # the bound on its rows makes this side safe to broadcast
    marked = own.join(F.broadcast(cut(picked).withColumn("good", F.lit(True))), "id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counted = marked.mapInPandas(_count(buckets), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    rows = counted.toPandas()  # one row per bucket
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    ratio = docs.sparkSession.sparkContext.broadcast(log_ratio(raw, target))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(buckets)
        for f in frames:
            weight, size = [], []
            for text in f["text"]:
                grams = hasher.grams(text)
                # rounded, so that the order of a sum doesn't show
                weight.append(round(float(ratio.value[grams].sum()), 6))
                size.append(len(grams))
            yield pd.DataFrame({"id": f["id"], "key": f["key"], "log_weight": weight, "n_grams": size})

    keyed = own.select("id", F.xxhash64("text").alias("key"), "text")
    out = keyed.mapInPandas(run, "id long, key long, log_weight double, n_grams long")
    # uniform in (0, 1), never at its ends
    uniform = (F.shiftrightunsigned(F.xxhash64("id", "key", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return out.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))


def resample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float | None = None, **settings) -> DataFrame:
    """The sampled documents: doc_id, log_weight, n_grams, gumbel_key, place (0-based, by falling key), kept (true).

    ``labels`` has the columns doc_id and quality (1: good).
    """
    good = labels.where("quality = 1").select("doc_id")
    if share is None:
        share = labels.agg(F.avg(F.col("quality").cast("double"))).first()[0]
        share = 1.0 if share is None else share
    # cut, so that dealing by ranges, which reads a sample of its rows first, doesn't hash the texts once more
    rows = cut(weighted(docs, good, doc_id, text, **settings))
    order = [F.col("gumbel_key").desc(), F.col("id"), F.col("key")]
    placed = ranked(rows, order, "place")
    k = round(share * placed.count())
    return placed.where(F.col("place") < k).select(
        unboxed(F.col("id")).alias(doc_id), "log_weight", "n_grams", "gumbel_key", "place", F.lit(True).alias("kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))


QUERIES = {"op9_resampling": query}
