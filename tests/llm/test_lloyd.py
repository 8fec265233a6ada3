import hashlib
import math

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from qloom.llm import lloyd as q
from qloom.sources.tables import scan


def brute(rows, k, rounds, scale=1024, width=64):
    """(id, cluster, distance, cluster inertia, inertia, hash) with Python integers."""
    kept = [
        (i, [max(-(1 << 27), min(1 << 27, math.floor(scale * x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [near(v) for _, v in kept]
    per = {}
    for d, j in last:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], sum(per.values()), sha[j]) for (i, _), (d, j) in zip(kept, last)), key=repr)


def frame(spark, rows, clashing=False):
    extra = ["x", "n", "vec", "block", "part", "cluster", "distance", "label"] if clashing else []
    fields = [StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))]
    schema = StructType(fields + [StructField(c, StringType() if k % 2 else IntegerType()) for k, c in enumerate(extra)])
    return spark.createDataFrame([(i, v, *[None] * len(extra)) for i, v in rows], schema)


def result(df):
    return sorted((tuple(r) for r in df.drop("centroid").collect()), key=repr)


@pytest.mark.parametrize("width,block,k", [(5, 2, 3), (4, 4, 2), (3, 1, 8)])
def test_blocks_of_any_width_give_the_rounds_of_whole_vectors(spark, width, block, k):
    rng = np.random.default_rng(width)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, width)]) for i in range(60)]
    got = q.clusters(frame(spark, rows), k=k, rounds=4, width=width, block=block)
    assert result(got) == brute(rows, k, 4, width=width)


def test_odd_rows(spark):
    good = [0.5, -0.25, 0.0]
    rows = [
        (1, good), (1, good), (1, [0.5, -0.25, 1.0]), (2, None), (3, []), (4, [1.0, 2.0]), (5, [1.0, None, 2.0]),
        (6, [1.0, float("nan"), 2.0]), (7, [float("inf"), 1.0, 2.0]), (None, good), (None, [3.0, 3.0, 3.0]),
        (8, [3e38, -3e38, 0.0]), (9, [-0.0, -0.0001, 0.0001]), ((1 << 60) + 1, [1.0, 1.0, 1.0]),
    ]
    for k in (3, 20):
        got = q.clusters(frame(spark, rows, clashing=True), k=k, rounds=3, width=3, block=2)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"]
        assert result(got) == brute(rows, k, 3, width=3)


def test_hot_vector_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(1000 + i, [float(i % 3), float(i % 2)]) for i in range(60)]
    assert result(q.clusters(frame(spark, rows), k=4, rounds=5, width=2, block=1)) == brute(rows, 4, 5, width=2)


def test_empty_table(spark):
    assert q.clusters(frame(spark, [])).count() == 0
    assert q.clusters(frame(spark, [(1, None)])).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in scan(spark, sf_dir, "embeddings").collect()]
    assert result(q.query(spark, sf_dir)) == brute(rows, 8, 10)
