"""Toxicity by weak supervision.

1. Lexicon and patterns. Over labelled training documents, words, word beginnings (4 to 7 letters, a pattern that stands for
   inflections and compounds) and beginnings shared by two or three words of the text and more are counted by label;
   the most telling ones are voters, each of which votes toxic where it occurs and abstains elsewhere. One more votes clean where no suspicious term occurs at all.
2. Label model. Expectation-maximisation over the votes estimates the share of toxic documents and how often each
   voter votes on either kind; it starts from the voters' counts in the lexicon and sees no document's label. Voters that agree more than their accuracies explain (correlation of what is left of
   two votes once the class is known) and speak on the same document share their evidence by how strongly they
   agree, so that one phrase counted by three voters isn't three witnesses.
3. Classifier. A logistic regression over hashed words and word beginnings is trained on the posterior of the label
   model, and scores every document.

Only ids whose crc32 modulo ``folds`` isn't 0 lend labels; a score reads the text alone. The lexicon, the label model and
the classifier are fitted on at most ``sample_rows`` labelled training documents, those with the smallest hash of their id;
everything is scored. Null and empty texts have no features and get the score of the bias alone. Very long texts are read
whole. Repeated rows get equal scores. With no labelled training document, or none of one kind, every score is the
share of toxic labels (0.5 without labels). Null ids are scored and held out, as they have no remainder.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from qloom.llm.shared import boxed, cut
from qloom.sources.tables import scan

FOLDS = 5
SAMPLE_ROWS = 10_000
MAX_VOTERS = 120
MIN_SEEN = 5
FEATURE_SEEN = 10
BITS = 18
BEGINNINGS = (4, 5, 6, 7)
KNOWN = 300_000
SEEDS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << BITS) - 1
_EDGE = b".,;:!?\"'()[]{}<>*%&$#|-_"


def words(text: str | None) -> set[bytes]:
    """Distinct words of a text, lower-cased (A-Z), without the punctuation around them."""
    if not isinstance(text, str):
        return set()
    out = {w.strip(_EDGE) for w in set(text.encode().lower().split())}
    out.discard(b"")
    return out


def beginnings(word: bytes) -> list[bytes]:
    """The first 4 to 7 letters of longer words, marked by a star."""
    text = word.decode()
    return [text[:n].encode() + b"*" for n in BEGINNINGS if len(text) > n]


def terms(text: str | None) -> set[bytes]:
    """Words and beginnings; beginnings of two and of three words or more once more, with as many stars."""
    own = words(text)
    counts = Counter(b for w in own for b in beginnings(w))
    return own.union(counts, (b + b"*" for b, n in counts.items() if n > 1), (b + b"**" for b, n in counts.items() if n > 2))


# ---------------------------------------------------------------- lexicon


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        seen: dict[bytes, list[int]] = {}
        for text, toxic in zip(f["text"], f["toxic"]):
            for t in terms(text):
                seen.setdefault(t, [0, 0])[toxic] += 1
        yield pd.DataFrame({"term": [t.decode() for t in seen], "clean": [n[0] for n in seen.values()], "toxic": [n[1] for n in seen.values()]})


def _surprise(counts: pd.DataFrame, n_toxic: int, n_clean: int) -> pd.Series:
    """How many standard deviations more often a term is toxic than its frequency lets expect."""
    expected = (counts["toxic"] + counts["clean"]) * (n_toxic / (n_toxic + n_clean))
    return (counts["toxic"] - expected) / np.sqrt(expected + 0.5)


def choose_voters(counts: pd.DataFrame, n_toxic: int, n_clean: int, limit: int = MAX_VOTERS) -> list[str]:
    """The most surprising terms that mean toxic more often than not at even odds by far; a term that begins like a stronger choice is left out, so that a
    stem is one voter.
    """
    odds = np.log((counts["toxic"] + 0.5) / (n_toxic + 1)) - np.log((counts["clean"] + 0.5) / (n_clean + 1))
    c = counts.assign(weight=_surprise(counts, n_toxic, n_clean))
    c = c[(c["toxic"] >= MIN_SEEN) & (odds > 2.0) & (c["weight"] > 6)].sort_values(["weight", "term"], ascending=[False, True])
    chosen: list[str] = []
    for t in c["term"]:
        if any("*" in p and t.startswith(p.rstrip("*")) for p in chosen):
            continue
        chosen.append(t)
        if len(chosen) == limit:
            break
    return chosen


def suspicious(counts: pd.DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Terms that lean to toxic beyond chance; a text without any of them is voted clean."""
    return sorted(counts["term"][(counts["toxic"] >= MIN_SEEN) & (_surprise(counts, n_toxic, n_clean) > 5)])


# ---------------------------------------------------------------- label model


class LabelModel:
    """Posterior chances that documents are toxic, from votes (documents x voters, 1: the voter speaks)."""

    def __init__(self, on_toxic: np.ndarray, on_clean: np.ndarray, prior: float, rounds: int = 60, correlated: float = 0.3):
        """How often each voter is held to speak on either kind before any vote is seen; those that speak on clean ones more often vote clean."""
        self.start = np.clip(on_toxic, 1e-4, 1 - 1e-4), np.clip(on_clean, 1e-4, 1 - 1e-4)
        self.toxic_voter = on_toxic > on_clean
        self.prior, self.rounds, self.correlated = prior, rounds, correlated

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        # a voter that abstains says nothing: its words may be of another language
        spoken = votes * np.log(self.on_toxic / self.on_clean) / np.maximum(votes @ self.agree, 1.0)
        odds = np.log(self.prior / (1 - self.prior)) + spoken.sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))

    def fit(self, votes: np.ndarray) -> LabelModel:
        start_toxic, start_clean = self.start
        start_prior = self.prior
        self.on_toxic, self.on_clean = start_toxic, start_clean
        self.agree = np.eye(votes.shape[1])
        strength = 20.0
        for step in range(2):
            for _ in range(self.rounds):
                p = self.posterior(votes)
                self.on_toxic = (p @ votes + strength * start_toxic) / (p.sum() + strength)
                self.on_clean = ((1 - p) @ votes + strength * start_clean) / ((1 - p).sum() + strength)
                self.prior = float((p.sum() + strength * start_prior) / (len(p) + strength))
            if step == 0:
                self._correlate(votes, self.posterior(votes))
        return self

    def _correlate(self, votes: np.ndarray, p: np.ndarray) -> None:
        """How much each two voters agree beyond what the class explains."""
        left = votes - (p[:, None] * self.on_toxic + (1 - p)[:, None] * self.on_clean)
        scale = np.sqrt((left**2).mean(axis=0)) + 1e-9
        self.correlations = np.clip((left.T @ left) / len(left) / np.outer(scale, scale), -1, 1)
        np.fill_diagonal(self.correlations, 1.0)
        same = (self.correlations > self.correlated) & np.equal.outer(self.toxic_voter, self.toxic_voter)
        self.agree = np.where(same, self.correlations, 0.0)


# ---------------------------------------------------------------- classifier


def _hashed(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - BITS)


class Features:
    """Hashed terms of a text; remembers a bounded number of words."""

    def __init__(self):
        self.known: dict[bytes, list[int]] = {}

    def of(self, text: str | None) -> np.ndarray:
        out: list[int] = []
        for w in words(text):
            got = self.known.get(w)
            if got is None:
                got = [_hashed(w), *map(_hashed, beginnings(w))]
                if len(self.known) < KNOWN:
                    self.known[w] = got
            out += got
        once, times = np.unique(np.array(out, np.int32), return_counts=True)
        # a beginning of several words is a feature of its own, at a place that its hash gives
        twice, thrice = once[times > 1], once[times > 2]
        return np.unique(np.concatenate([once, (twice * 5 + 1) & _MASK, (thrice * 9 + 2) & _MASK]).astype(np.int32))


def train(rows: list[np.ndarray], chance: np.ndarray, rounds: int = 150, rate: float = 0.3, decay: float = 2e-3) -> tuple[np.ndarray, float]:
    """(weights, bias) of a logistic regression on soft labels: full-batch Adam, features that occur in fewer than FEATURE_SEEN documents left out."""
    at = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    often = np.bincount(at, minlength=1 << BITS) >= FEATURE_SEEN
    use = often[at]
    at, doc = at[use], doc[use]
    weights = np.zeros(1 << BITS)
    share = float(np.clip(chance.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0
    for k in range(1, rounds + 1):
        odds = np.bincount(doc, weights[at], len(rows)) + bias
        off = 1 / (1 + np.exp(-np.clip(odds, -40, 40))) - chance
        slope = np.bincount(at, off[doc], 1 << BITS) / len(rows) + decay * weights
        slope_b = off.mean()
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        mb, vb = 0.9 * mb + 0.1 * slope_b, 0.999 * vb + 0.001 * slope_b**2
        step = rate / (1 + k / 20)
        fix1, fix2 = 1 - 0.9**k, 1 - 0.999**k
        weights = weights - step * (m / fix1) / (np.sqrt(v / fix2) + 1e-4)
        bias -= step * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-4)
    return weights, bias


# ---------------------------------------------------------------- jobs


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


@F.pandas_udf(ArrayType(LongType()))
def sketch(texts: pd.Series) -> pd.Series:
    """The smallest hash of a text's three-word windows under each of a few seeds: near copies share most of them."""
    out = []
    for t in texts:
        own = t.encode().lower().split() if isinstance(t, str) else []
        windows = {b" ".join(own[k : k + 3]) for k in range(max(1, len(own) - 2))}
        base = np.array([xxhash.xxh64_intdigest(w) for w in windows], np.uint64)
        out.append([int(((base ^ np.uint64(seed)) * _MIX).min() >> np.uint64(1)) for seed in SEEDS])
    return pd.Series(out)


def _witnesses(sample: DataFrame) -> DataFrame:
    """One document of each group of exact or near copies, a toxic one first: copies are one witness for their words."""
    rows = cut(sample.select("id", "toxic", "text", sketch("text").alias("marks")))
    own = rows.select(F.struct("toxic", "id", "marks", F.xxhash64("text").alias("key")).alias("own"))
    for k in range(len(SEEDS)):
        own = own.groupBy(F.col("own.marks")[k]).agg(F.max("own").alias("own")).select("own")
    kept = own.select("own.id", "own.key").distinct()
    return rows.withColumn("key", F.xxhash64("text")).join(F.broadcast(kept), ["id", "key"]).dropDuplicates(["id", "key"]).select("id", "toxic", "text")


def model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float, dict]:
    """(weights, bias, what was learned) from labelled documents outside the held-out fold."""
    own = labels.where("toxic is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    picked = own.where(~held_out(F.col("id"), folds)).dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    # the bound on its rows makes this side safe to broadcast
    picked = F.broadcast(cut(picked))
    sample = docs.select(boxed(F.col(f"`{doc_id}`")).alias("id"), F.col(f"`{text}`").alias("text")).join(picked, "id")
    sample = cut(_witnesses(sample))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / (n_toxic + n_clean) if n else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.zeros(1 << BITS), float(np.log(share / (1 - share))), {}
    counts = (
        sample.select("text", "toxic")
        .mapInPandas(_counted, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("toxic >= 3")
        .toPandas()
    )
    voters = choose_voters(counts, n_toxic, n_clean)
    doubt = frozenset(x.encode() for x in suspicious(counts, n_toxic, n_clean))
    asked = [v.encode() for v in voters]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for f in frames:
            votes, grams = [], []
            for t in f["text"]:
                found = terms(t)
                votes.append([k for k, v in enumerate(asked) if v in found] + ([] if found & doubt else [len(asked)]))
                grams.append(features.of(t).tobytes())
            yield pd.DataFrame({"id": f["id"], "votes": votes, "grams": grams})

    # bounded by sample_rows; ordered, so that sums come out alike on every run
    rows = sample.select("id", "text").mapInPandas(read, "id long, votes array<int>, grams binary").toPandas()
    rows = rows.sort_values(["id", "grams"]).reset_index(drop=True)
    votes = np.zeros((len(rows), len(asked) + 1))
    for k, said in enumerate(rows["votes"]):
        votes[k, np.asarray(said, int)] = 1
    known = counts.set_index("term").loc[voters]
    on_toxic, on_clean = (known["toxic"] + 0.5) / (n_toxic + 1), (known["clean"] + 0.5) / (n_clean + 1)
    labeller = LabelModel(np.append(on_toxic, 0.05), np.append(on_clean, 0.8), n_toxic / (n_toxic + n_clean)).fit(votes)
    chance = labeller.posterior(votes)
    weights, bias = train([np.frombuffer(g, np.int32) for g in rows["grams"]], chance)
    return weights, bias, {"voters": voters, "on_toxic": labeller.on_toxic, "on_clean": labeller.on_clean, "agree": labeller.agree, "prior": labeller.prior}


def scores(docs: DataFrame, weights: np.ndarray, bias: float, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf(DoubleType())
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        table = sent.value.astype(np.float64)
        for texts in parts:
            odds = np.array([round(float(table[features.of(t)].sum()), 6) for t in texts]) + bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -40, 40))), dtype="float64")

    found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), score(F.col(f"`{text}`")).alias("score"))
    return found.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    weights, bias, _ = model(docs, scan(spark, sf_dir, "labels"))
    return scores(docs, weights, bias)


QUERIES = {"op5_toxicity": query}
