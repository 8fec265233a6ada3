import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from qloom.llm import whitening as q
from qloom.sources.tables import scan


def frame(spark, rows, clashing=False):
    extra = ["x", "w", "z", "away", "n", "component", "at", "label"] if clashing else []
    fields = [StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))]
    schema = StructType(fields + [StructField(c, StringType() if k % 2 else IntegerType()) for k, c in enumerate(extra)])
    return spark.createDataFrame([(i, v, *[None] * len(extra)) for i, v in rows], schema)


def brute(rows, weights="one", scale=256):
    """Kept (id, x), fit list, its weights, n, S, eigenvalues, vectors and trace, from exact covariances."""
    kept = [(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + (0,) * (dims - len(x))) for i, x in kept]
    counts = {}
    for _, x in kept:
        counts[x] = counts.get(x, 0) + 1
    fit = {x: c if weights == "counts" else 1 for x, c in counts.items()}
    n = sum(fit.values())
    sums = [sum(x[d] * w for x, w in fit.items()) for d in range(dims)]
    centred = {x: [n * a - s for a, s in zip(x, sums)] for x in fit}
    cov = np.array([[float(Fraction(sum(fit[x] * y[i] * y[j] for x, y in centred.items()), n**3)) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:4]
    return kept, centred, n, values[order], vectors[:, order], np.trace(cov)


def held(spark, rows, got, weights="one", places=6):
    kept, centred, n, values, vectors, trace = brute(rows, weights)
    got = got.collect()
    assert len(got) == len(kept) * len(values)
    mine = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-6, abs=1e-12)
        mine.setdefault((r["vec_id"], int(r["deviation"])), []).append((r["component"], r["whitened"]))
    want = {}
    for i, x in kept:
        y = centred[x]
        z = [(np.array([float(Fraction(a, n)) for a in y]) @ vectors[:, k]) / math.sqrt(e) if e > 1e-9 * values[0] else 0.0 for k, e in enumerate(values)]
        want.setdefault((i, sum(a * a for a in y)), []).extend((k + 1, v) for k, v in enumerate(z))
    assert mine.keys() == want.keys()
    # either sign, the same for all rows
    flip = {}
    for key in want:
        for (c, a), (d, b) in zip(sorted(mine[key], key=lambda t: (t[0], abs(t[1]))), sorted(want[key], key=lambda t: (t[0], abs(t[1])))):
            assert c == d and abs(a) == pytest.approx(abs(b), abs=10**-places)
            if abs(b) > 1e-4:
                assert flip.setdefault(c, a * b > 0) == (a * b > 0)


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_repeated_vectors_fit_by_their_weights(spark, weights):
    rng = np.random.default_rng(1)
    some = [[float(x) for x in rng.normal(0, [4, 3, 2, 1, 0.5, 0.2])] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(some)] + [(100 + i, some[0]) for i in range(50)] + [(200 + i, some[i % 5]) for i in range(20)]
    held(spark, rows, q.whitened(frame(spark, rows), weights=weights), weights)


def test_odd_rows(spark):
    rows = [
        (1, [0.5, -0.25, 1.0, 2.0, 0.1]), (1, [0.5, -0.25, 1.0, 2.0, 0.1]), (1, [1.5, 0.25, -1.0, 0.0, 3.3]), (2, None), (3, []),
        (4, [1.0, 2.0]), (5, [1.0, None, 2.0]), (6, [1.0, float("nan")]), (7, [float("-inf")]), (None, [9.0, 1.0, -3.0, 0.2, -0.4]),
        (8, [-0.0, 0.001, -0.001, 7.0, 1.0]), ((1 << 60) + 1, [2.0, -7.0, 1.0, 1.0, 1.0]),
    ]
    held(spark, rows, q.whitened(frame(spark, rows, clashing=True)))


def test_values_beyond_a_long(spark):
    rows = [(i, [1e12 * i, -3e11 * i * i, 5.0 * (i % 3)]) for i in range(9)]
    kept, centred, n, values, vectors, trace = brute(rows)
    got = q.whitened(frame(spark, rows)).collect()
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == {(i, sum(a * a for a in centred[x])) for i, x in kept}


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [0.0, 0.0]), (2, [1.0, 1.0])]])
def test_components_without_variance(spark, rows):
    got = q.whitened(frame(spark, rows)).collect()
    assert len(got) == 2 * len(rows) and all(r["identity_error"] < 1e-9 for r in got)
    assert {r["whitened"] for r in got if r["component"] == 2} == {0.0}


def test_empty_table(spark):
    assert q.whitened(frame(spark, [])).count() == 0
    assert q.whitened(frame(spark, [(1, None), (2, [])])).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in scan(spark, sf_dir, "embeddings").collect()]
    got = q.query(spark, sf_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    held(spark, rows, got)
