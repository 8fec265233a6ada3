"""Centroid clustering by Lloyd's rounds over column blocks of the vectors.

Each distinct vector is cut into blocks of columns. The blocks are dealt by (block, vector) once and stay where
they are: a task holds one block's slices, computes their exact partial squared distances to the same slices of
all centroids, and the partial distances of a vector are added and the least taken. The assignment goes back to
the blocks, each of which sums its own columns per cluster and so gives its own slice of the new centroids. Only
the centroids (``k`` times the number of columns) pass the driver.

Values are integers, so every distance, sum and floor is exact. Equal vectors are one row with a count, which also
splits a vector that a large part of the rows holds.

Rows whose vector is null, has another length, or holds a null or non-finite entry are left out. Entries whose
scaled value lies beyond ±2^27 count as ±2^27, so that no distance leaves the range of a long. Repeated rows are
assigned like any others; start vectors that tie (one id, several vectors) are taken in the vectors' order, null ids
last. With fewer kept rows than ``k`` there are as many centroids; an empty table gives no rows. Other columns of
the input, whatever their names, aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from qloom.llm.shared import cut, in_place, placed
from qloom.sources.tables import scan

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
WIDTH = 64
BLOCK = 16
_MOST = float(1 << 27)


def kept_vectors(rows: DataFrame, vec_id: str, embedding: str, width: int, scale: int) -> DataFrame:
    """(id, x): the rows with a whole vector, its entries as scaled integers."""
    own = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    whole = own.where((F.size("v") == width) & ~F.exists("v", odd))
    least = lambda c: F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), F.floor(c * scale)))
    return whole.select("id", F.transform("v", lambda c: least(c).cast("long")).alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the ``k`` rows whose id has the smallest hash under the seed."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.select(place.alias("place"), "x").orderBy(F.asc_nulls_last("place"), "x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64)


def column_blocks(distinct: DataFrame, width: int, block: int) -> DataFrame:
    """(block, vec, part, n): each vector's slices, dealt by block and vector and kept in that order."""
    slices = F.transform(F.sequence(F.lit(0), F.lit((width - 1) // block)), lambda b: F.struct(b.alias("block"), F.slice("x", b * block + 1, block).alias("part")))
    rows = distinct.select("vec", "n", F.explode(slices).alias("s")).select("s.block", "vec", "s.part", "n")
    return in_place(placed(rows, "block", "vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch's rows by block: they lie one after the other."""
    blocks = batch.column("block").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(blocks) else []
    for a, b in zip(starts, [*starts[1:], len(blocks)]):
        yield int(blocks[a]), batch.slice(a, b - a)


def _partial_distances(centroids: np.ndarray, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, rows in _runs(batch):
                x, c = _matrix(rows.column("part")), centroids[:, b * block : (b + 1) * block]
                away = [((x - own) ** 2).sum(axis=1) for own in c]
                yield pa.RecordBatch.from_arrays([rows.column("vec"), *map(pa.array, away)], ["vec", *(f"d{i}" for i in range(len(c)))])

    return run


def assigned(blocks: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """(vec, cluster, distance): partial distances added over the blocks of a vector, the least taken, ties to the smaller number."""
    names = [f"d{i}" for i in range(len(centroids))]
    schema = ", ".join(["vec long", *(f"{n} long" for n in names)])
    sums = blocks.mapInArrow(_partial_distances(centroids, block), schema).groupBy("vec").agg(*[F.sum(n).alias(n) for n in names])
    least = F.array_min(F.array(*[F.struct(F.col(n).alias("distance"), F.lit(i).alias("cluster")) for i, n in enumerate(names)]))
    return sums.select("vec", least.alias("best")).select("vec", "best.cluster", "best.distance")


def _block_sums(k: int):
    """Sums of a task's slices per block and cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, rows in _runs(batch):
                x, n = _matrix(rows.column("part")), rows.column("n").to_numpy()
                own = rows.column("cluster").to_numpy()
                if b not in sums:
                    counts[b], sums[b] = np.zeros(k, np.int64), np.zeros((k, x.shape[1]), np.int64)
                np.add.at(counts[b], own, n)
                np.add.at(sums[b], own, x * n[:, None])
        for b in sums:
            for c in np.flatnonzero(counts[b]):
                yield pa.RecordBatch.from_pydict({"block": [b], "cluster": [int(c)], "n": [int(counts[b][c])], "sums": [sums[b][c].tolist()]}, schema=_SUMS)

    return run


_SUMS = pa.schema([("block", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


def next_centroids(blocks: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """Each block's new slices: floor of the mean of its columns per cluster; an empty cluster keeps its centroid."""
    k = len(centroids)
    back = assigned(blocks, centroids, block).select("vec", "cluster")
    width = centroids.shape[1]
    every = F.sequence(F.lit(0), F.lit((width - 1) // block))
    own = blocks.join(back.select("vec", "cluster", F.explode(every).alias("block")), ["block", "vec"]).select("block", "part", "n", "cluster")
    parts = own.sortWithinPartitions("block").mapInArrow(_block_sums(k), "block int, cluster int, n long, sums array<long>")
    cells = parts.select("block", "cluster", "n", F.posexplode("sums").alias("at", "total"))
    means = cells.groupBy("block", "cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    floored = means.select("block", "cluster", "at", F.expr("(total - pmod(total, n)) div n").alias("value"))
    new = centroids.copy()
    for r in floored.collect():  # k times the width at most
        new[r["cluster"], r["block"] * block + r["at"]] = r["value"]
    return new


def clusters(
    rows: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    width: int = WIDTH,
    block: int = BLOCK,
    seed: int = 3,
) -> DataFrame:
    """One row per kept vector: id, cluster, distance, the inertia of its cluster and of all, its centroid and that one's hash."""
    out = f"`{vec_id}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    kept = cut(kept_vectors(rows, vec_id, embedding, width, scale))
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], out)
    distinct = cut(kept.groupBy("x").agg(F.count("*").alias("n")).withColumn("vec", F.monotonically_increasing_id()))
    blocks = column_blocks(distinct, width, block)
    for _ in range(rounds):
        centroids = next_centroids(blocks, centroids, block)
    last = cut(assigned(blocks, centroids, block))
    wide = lambda c: c.cast("decimal(38,0)")
    # one row per cluster, so it's bounded by k
    totals = last.join(distinct.select("vec", "n"), "vec").groupBy("cluster").agg(F.sum(wide(F.col("distance")) * F.col("n")).alias("own")).collect()
    own = {r["cluster"]: int(r["own"]) for r in totals}
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    made = [(i, _long(t), _long(sum(own.values())), centroids[i].tolist(), hashes[i]) for i, t in sorted(own.items())]
    about = rows.sparkSession.createDataFrame(made, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    found = distinct.select("x", "vec").join(last, "vec").join(F.broadcast(about), "cluster").drop("vec")
    # cut, so that the join stands alone and adaptive execution may split a hot vector
    return kept.join(cut(found), "x").select(F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")


def _long(x: int) -> int | None:
    """Null where a sum over all rows leaves the range of a long."""
    return x if x < 1 << 63 else None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(scan(spark, sf_dir, "embeddings")).drop("centroid")


QUERIES = {"op13_lloyd": query}


def _oracle(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    near = """
        SELECT vec, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT v.vec, m.c, CAST(sum((v.x - m.x) * (v.x - m.x)) AS BIGINT) AS d
            FROM v JOIN c{0} m ON m.dim = v.dim GROUP BY v.vec, m.c) GROUP BY vec"""
    steps = []
    for r in range(1, rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(r - 1)})")
        steps.append(
            f"""c{r} AS MATERIALIZED (
        SELECT old.c, old.dim, coalesce(new.x, old.x) AS x FROM c{r - 1} old LEFT JOIN (
            SELECT a.c, v.dim, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
            FROM a{r} a JOIN v ON v.vec = a.vec GROUP BY a.c, v.dim) new ON new.c = old.c AND new.dim = old.dim)"""
        )
    return f"""
    WITH whole AS MATERIALIZED (
        SELECT row_number() OVER () AS vec, vec_id, list_transform(embedding, lambda y: CAST(floor(1024 * CAST(y AS DOUBLE)) AS BIGINT)) AS xs
        FROM embeddings WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
    v AS MATERIALIZED (SELECT vec, unnest(xs) AS x, generate_subscripts(xs, 1) AS dim FROM whole),
    c0 AS MATERIALIZED (
        SELECT c, unnest(xs) AS x, generate_subscripts(xs, 1) AS dim FROM (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), xs) - 1 AS c, xs FROM whole) WHERE c < {k}),
    {", ".join(steps)},
    a AS MATERIALIZED ({near.format(rounds)}),
    own AS (SELECT c, sum(d) AS d FROM a GROUP BY c),
    hashes AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS h FROM c{rounds} GROUP BY c)
    SELECT whole.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(own.d AS BIGINT) AS cluster_inertia,
        CAST((SELECT sum(d) FROM a) AS BIGINT) AS inertia, h AS centroid_sha256
    FROM whole JOIN a USING (vec) JOIN own USING (c) JOIN hashes USING (c)"""


ORACLES = {"op13_lloyd": _oracle()}
