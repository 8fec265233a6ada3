"""Embedding whitening fitted on distinct vectors with weights.

Equal scaled vectors are one row of the fit list, with weight one or their count. Two passes over that list give its
size and sums, as exact integers, and then the covariance: each task centres its vectors, multiplies them by their
weights and adds one small matrix. The eigenvectors of that matrix (columns by columns, so bounded by the vectors'
length) are found on the driver. Each distinct vector is projected once and joined back to the rows that hold it.

Rows whose vector is null or holds null or non-finite entries are left out. Vectors shorter than the longest count as
filled up with zeros; an empty vector is one of zeros. Repeated rows give repeated results; null ids stay. A component
without variance (equal vectors only, or fewer vectors than components) has whitened value 0 and explained share 0, and
is left out of ``identity_error``. ``deviation`` is exact and null where it leaves the range of its type. An empty table
gives no rows. Other columns of the input, whatever their names, aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import cut
from qloom.sources.tables import scan

COMPONENTS = 4
SCALE = 256
# sums are kept as high and low halves, so that neither leaves a long before 2^31 rows of one task
_LOW = (1 << 32) - 1


def scaled(rows: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(id, x): the rows with a finite vector, its entries as scaled integers (beyond a long: its end)."""
    own = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return own.where(F.col("v").isNotNull() & ~F.exists("v", odd)).select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"))


def fit_list(kept: DataFrame, weights: str) -> DataFrame:
    """(x, w): each distinct vector with its weight, ``one`` or ``counts``."""
    weight = {"one": F.lit(1).cast("long"), "counts": F.count("*")}[weights]
    return kept.groupBy("x").agg(F.count("*").alias("n_rows"), weight.alias("w"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _sums(dims: int):
    """One row a task and dimension: weights and the halves of the weighted sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dims, 0
        for batch in batches:
            x, w = _matrix(batch.column("x"), dims), batch.column("w").to_numpy()
            n += int(w.sum())
            if (w == 1).all():
                high, low = (x >> 32).sum(axis=0), (x & _LOW).sum(axis=0)
                parts = [(int(a) << 32) + int(b) for a, b in zip(high, low)]
            else:
                parts = [int(s) for s in (x.astype(object) * w[:, None].astype(object)).sum(axis=0)] if len(x) else [0] * dims
            total = [a + b for a, b in zip(total, parts)]
        if n:
            yield pa.RecordBatch.from_pydict(
                {"dim": list(range(dims)), "w": [n] * dims, "high": [t >> 32 for t in total], "low": [t & _LOW for t in total]},
                schema=pa.schema([("dim", pa.int32()), ("w", pa.int64()), ("high", pa.int64()), ("low", pa.int64())]),
            )

    return run


def moments(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Total weight and exact weighted sums per dimension."""
    parts = fit.select("x", "w").mapInArrow(_sums(dims), "dim int, w long, high long, low long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = sorted(parts.groupBy("dim").agg(wide("w"), wide("high"), wide("low")).collect())  # one row a dimension
    return int(rows[0]["w"]), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in longs where they suffice, else as Python integers."""
    most = max(int(x.max()), -int(x.min()), 0) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _products(dims: int, n: int, sums: list[int]):
    """A task's part of the covariance: its centred vectors times their weights times themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = (_centred(_matrix(batch.column("x"), dims), n, sums) / n).astype(np.float64)
            part = (y * batch.column("w").to_numpy()[:, None]).T @ y
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "line": pa.array(total.tolist(), pa.list_(pa.float64()))})

    return run


def covariance(fit: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    parts = fit.select("x", "w").mapInArrow(_products(dims, n, sums), "dim int, line array<double>")
    cells = parts.select("dim", F.posexplode("line").alias("other", "value")).groupBy("dim", "other").agg(F.sum("value").alias("value"))
    out = np.zeros((dims, dims))
    for r in cells.collect():  # dimensions by dimensions
        out[r["dim"], r["other"]] = r["value"] / n
    return (out + out.T) / 2


def principal(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues, falling, their unit vectors as columns, and the trace. Below rounding they count as zero."""
    values, vectors = np.linalg.eigh(cov)
    first = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[first], vectors[:, first]
    noise = len(cov) * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    return np.where(values > noise, values, 0.0), vectors, float(np.trace(cov))


def _whiten(dims: int, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
    scale = np.where(values > 0, 1 / np.sqrt(np.where(values > 0, values, 1)), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _centred(_matrix(batch.column("x"), dims), n, sums)
            z = (y / n).astype(np.float64) @ vectors * scale
            most = int(abs(y).max()) if y.size else 0
            if y.dtype != object and most * most * max(dims, 1) < 1 << 63:
                away = (y * y).sum(axis=1).tolist()
            else:
                away = [int(s) for s in (y.astype(object) ** 2).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("w"), pa.array([str(a) for a in away], pa.string()), pa.array(z.tolist(), pa.list_(pa.float64()))],
                ["x", "w", "away", "z"],
            )

    return run


def identity_error(white: DataFrame, n: int, live: list[int]) -> float:
    """Largest entry of the whitened fit list's covariance, centred first, minus the identity; live: components with variance."""
    if not live:
        return 0.0
    z = lambda i: F.col("z")[i]
    mean = white.agg(*[F.sum(z(i) * F.col("w")) for i in live]).first()
    centred = {i: z(i) - F.lit(m / n) for i, m in zip(live, mean)}
    pairs = [(i, j) for i in live for j in live if i <= j]
    sums = white.agg(*[F.sum(centred[i] * centred[j] * F.col("w")) for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs))


def whitened(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, weights: str = "one"
) -> DataFrame:
    """One row per kept row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``weights`` says what a distinct vector counts in the fit: ``one``, or ``counts`` for its number of rows. ``n`` is the
    total weight, ``deviation`` (decimal) the sum of (n * x - S)^2 over the dimensions.
    """
    kept = cut(scaled(rows, vec_id, embedding, scale))
    fit = cut(fit_list(kept, weights))
    dims = fit.agg(F.max(F.size("x"))).first()[0] or 0
    out = f"`{vec_id}` long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not dims:
        return rows.sparkSession.createDataFrame([], out)
    n, sums = moments(fit, dims)
    values, vectors, trace = principal(covariance(fit, dims, n, sums), components)
    # cut, so that the join below stands alone and adaptive execution may split a hot vector
    white = cut(fit.select("x", "w").mapInArrow(_whiten(dims, n, sums, values, vectors), "x array<long>, w long, away string, z array<double>"))
    error = identity_error(white, n, [i for i, e in enumerate(values) if e > 0])
    shares = F.array(*[F.lit(float(e / trace) if trace > 0 else 0.0) for e in values])
    found = kept.join(white.drop("w"), "x")
    return found.select("id", "away", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(vec_id),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.col("away").try_cast("decimal(38,0)").alias("deviation"),
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitened(scan(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {"op12_whitening": query}
