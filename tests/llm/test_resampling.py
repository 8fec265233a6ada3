import numpy as np

from qloom.llm import resampling as q
from qloom.llm.shared import ranked
from tests.llm import frames


def brute(docs, good, buckets):
    hasher = q.Hasher(buckets)
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for i, t in docs:
        for g in hasher.grams(t):
            raw[g] += 1
            target[g] += i in good
    ratio = q.log_ratio(raw, target)
    return {i: sum(ratio[g] for g in hasher.grams(t)) for i, t in docs}


def corpus(n=300):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(n):
        own = rng.choice([f"word{j}" for j in range(200)], 30)
        rows.append((k, " ".join(own if k % 5 else [f"{w}%%%" for w in own])))
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(i, int(i % 5 > 0)) for i, _ in rows if i is not None and i % 2], "doc_id long, quality int")


def test_weights_by_definition(spark):
    rows = corpus()
    good = labels(spark, rows).where("quality = 1").select("doc_id")
    want = brute(rows, {r[0] for r in good.collect()}, 512)
    got = {r["id"]: r["log_weight"] for r in q.weighted(frames.documents(spark, rows), good, buckets=512).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-5 for i in want)


def test_grams_are_words_and_pairs():
    hasher = q.Hasher(1 << 40)
    a, b = hasher.grams("The cat"), hasher.grams("the CAT  sat")
    assert len(a) == 3 and len(b) == 5 and set(a) < set(b)
    assert hasher.grams("a b")[2] != hasher.grams("b a")[2]


def test_top_k_by_key_and_junk_left_out(spark):
    rows = corpus()
    docs = frames.documents(spark, rows)
    known = labels(spark, rows)
    keys = q.weighted(docs, known.where("quality = 1").select("doc_id")).collect()
    kept = q.resample(docs, known, share=0.8).collect()
    assert len(kept) == 240 and sorted(r["place"] for r in kept) == list(range(240))
    want = sorted(keys, key=lambda r: (-r["gumbel_key"], r["id"]))[:240]
    assert [r["doc_id"] for r in sorted(kept, key=lambda r: r["place"])] == [r["id"] for r in want]
    assert len([r for r in kept if r["doc_id"] % 5 == 0]) <= 6
    assert {tuple(r) for r in q.resample(docs, known, share=0.8).collect()} == {tuple(r) for r in kept}


def test_gumbel_draws_follow_the_weights(spark):
    # equal weights: every document is drawn alike often
    from pyspark.sql import functions as F

    docs = frames.documents(spark, [(k, "") for k in range(2000)])
    none = docs.select("doc_id").where("false")
    keys = np.array([r[0] for r in q.weighted(docs, none).select("gumbel_key").collect()])
    assert abs(keys.mean() - 0.5772) < 0.1 and abs(keys.var() - np.pi**2 / 6) < 0.25
    assert q.weighted(docs, none).agg(F.max(F.abs("log_weight"))).first()[0] == 0


def test_odd_rows(spark):
    known = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (None, 1)], "doc_id long, quality int")
    docs = frames.odd(spark)
    whole = q.resample(docs, known, share=1.0).collect()
    assert sorted((r["doc_id"] for r in whole), key=str) == sorted((i for i, _ in frames.ODD), key=str)
    assert {r["n_grams"] for r in whole if r["doc_id"] in (2, 3, 4, 8)} == {0}
    assert q.resample(docs, known.where("false")).count() == len(frames.ODD)
    assert q.resample(docs, known, share=0.0).count() == 0


def test_empty_table(spark):
    known = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert q.resample(frames.nothing(spark), known).count() == 0


def test_ranks_are_complete(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).select((F.col("id") % 10).alias("x"), "id")
    got = [(r["x"], r["id"]) for r in sorted(ranked(df, [F.col("x").desc(), F.col("id")], "rank").collect(), key=lambda r: r["rank"])]
    assert got == sorted(got, key=lambda t: (-t[0], t[1])) and len(got) == 1000
