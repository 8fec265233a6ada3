import os
import zlib

import numpy as np
import pytest

from qloom.llm import toxicity as q
from tests.llm import frames


def corpus(spark, n=1500, seed=4):
    """Documents of two invented languages, toxic ones with insults or with compounds of a toxic stem, and their labels."""
    rng = np.random.default_rng(seed)
    vocabulary = [[f"{a}{b}{c}" for a in "bdgklm" for b in "aeiou" for c in ("n", "rs", "th", x)] for x in ("ing", "ung")]
    insults = [["grobbel", "flemmer", "snurk"], [f"schnod{e}" for e in ("ich", "ung", "er", "heit", "e")]]
    rows, labels = [], []
    for k in range(n):
        lang = int(rng.integers(0, 2))
        own = list(rng.choice(vocabulary[lang], int(rng.integers(20, 80))))
        toxic = rng.random() < 0.15
        if toxic:
            for w in rng.choice(insults[lang], int(rng.integers(1, 4))):
                own.insert(int(rng.integers(0, len(own))), w.capitalize() if rng.random() < 0.3 else w + ("." if rng.random() < 0.3 else ""))
        rows.append((k, " ".join(own)))
        labels.append((k, 1, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def auc(scores, truth):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    p, n = truth.sum(), (~truth).sum()
    return (rank[truth].sum() - p * (p + 1) / 2) / (p * n)


def test_held_out_accuracy_and_fold(spark):
    rows, labels = corpus(spark)
    docs = frames.documents(spark, rows)
    weights, bias, learned = q.model(docs, labels)
    assert {"grob*", "flem*", "snur*", "schn*"} <= {v[:5] for v in learned["voters"]}
    toxic = {r["doc_id"]: bool(r["toxic"]) for r in labels.collect()}
    out = q.scores(docs, weights, bias).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"]]
    truth = np.array([toxic[r["doc_id"]] for r in held])
    assert auc(np.array([r["score"] for r in held]), truth) > 0.97
    assert np.mean([r["predicted"] == t for r, t in zip(held, truth)]) > 0.93


def test_held_out_labels_and_other_columns_lend_nothing(spark):
    from pyspark.sql import functions as F

    rows, labels = corpus(spark, 400)
    docs = frames.documents(spark, rows)
    turned = labels.withColumn("toxic", F.when(q.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = q.model(docs, labels), q.model(docs.withColumn("lang", F.lit("zz")), turned)
    assert (one[0] == two[0]).all() and one[1] == two[1]


def test_copies_are_one_witness(spark):
    rows, labels = corpus(spark, 800)
    copy = " ".join(["uniquely", "worded", "passage", "holding", "grobbel"] + [f"copied{k}" for k in range(40)])
    rows += [(10_000 + k, f"{copy} tail{k}") for k in range(60)]
    labels = labels.union(spark.createDataFrame([(10_000 + k, 1, 1) for k in range(60)], labels.schema))
    _, _, learned = q.model(frames.documents(spark, rows), labels)
    assert not [v for v in learned["voters"] if v.startswith(("copie", "uniq", "worde"))]


def test_label_model_learns_accuracies_and_agreement():
    rng = np.random.default_rng(7)
    truth = rng.random(30_000) < 0.2
    on_toxic, on_clean = np.array([0.6, 0.5, 0.4, 0.3]), np.array([0.02, 0.05, 0.01, 0.02])
    votes = (rng.random((30_000, 4)) < np.where(truth[:, None], on_toxic, on_clean)).astype(float)
    votes = np.column_stack([votes, votes[:, 3], 1 - votes.max(axis=1)])  # a voter that repeats another, and the one for clean
    model = q.LabelModel(np.array([0.3, 0.3, 0.3, 0.3, 0.3, 0.1]), np.array([0.03, 0.03, 0.03, 0.03, 0.03, 0.9]), 0.1).fit(votes)
    assert model.correlations[3, 4] > 0.9 and abs(model.correlations[0, 1]) < 0.3
    assert model.agree[3, 4] > 0.9 and model.agree[0, 1] == 0
    assert auc(model.posterior(votes), truth) > 0.85


def test_odd_rows(spark):
    rows, labels = corpus(spark, 300)
    weights, bias, _ = q.model(frames.documents(spark, rows + frames.ODD), labels)
    out = q.scores(frames.odd(spark), weights, bias).collect()
    assert len(out) == len(frames.ODD)
    blank = {r["score"] for r in out if r["doc_id"] in (2, 3, 4, 8)}
    assert len(blank) == 1 and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] for r in out if r["doc_id"] is None)
    assert {r["score"] for r in out if r["doc_id"] == 6} == {r["score"] for r in out if r["doc_id"] == 7}


def test_without_labels_and_documents(spark):
    rows, labels = corpus(spark, 30)
    none = labels.where("false")
    weights, bias, _ = q.model(frames.documents(spark, rows), none)
    assert {r["score"] for r in q.scores(frames.documents(spark, rows), weights, bias).collect()} == {0.5}
    weights, bias, _ = q.model(frames.nothing(spark), labels)
    assert q.scores(frames.nothing(spark), weights, bias).count() == 0


def test_query_on_held_out_rows(spark, sf_dir):
    from qloom.sources.tables import scan

    assert q.query(spark, sf_dir).count() == scan(spark, sf_dir, "documents").count()
    # a table large enough to learn from
    larger = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.1")
    if not os.path.isdir(larger):
        pytest.skip("no larger table")
    out = q.query(spark, larger).join(scan(spark, larger, "labels"), "doc_id").where("held_out").collect()
    truth = np.array([r["toxic"] == 1 for r in out])
    assert auc(np.array([r["score"] for r in out]), truth) > 0.9
