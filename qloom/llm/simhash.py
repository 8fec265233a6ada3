"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Two nodes of the trie at one depth are visited together. Their error is the number of bits in which their
paths differ; a pair of nodes whose error passes the budget is dropped with all that hangs below it.

The trie is spread over tasks by the pigeonhole rule: of ``distance`` + 1 blocks of bits, a linked pair has
one block without an error. The fingerprints are therefore rotated so that each block leads once, and the
walk starts at the nodes one block deep, paired with themselves, with no error yet. Equal fingerprints are
one leaf. Pairs of nodes with more than ``walk`` leaves are rows of a table: each round takes them ``STEP`` bits down, joins the
children that are there and drops the pairs whose error passes the budget. A pair of fewer leaves is walked to its end by one task. So
a block of any size is the same walk, spread over more tasks.

Texts: null and empty texts and texts without a word have fingerprint zero and link like any other. Very long
texts are read whole. Rows with the same id and text are one document; a null id counts as the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from qloom.llm.components import components
from qloom.llm.shared import cut
from qloom.sources.tables import scan

BITS = 64
SHINGLE = 3
DISTANCE = 2
# leaves below a pair of nodes that one task walks in memory
WALK = 4096
# bits that a round takes the pairs of larger nodes down
STEP = 7


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The majority bits of the shingles' XXH64 (seed 42), as a signed number."""
    # bytes.lower() changes A-Z only
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for long texts
        part = np.array(hashes[at : at + 65536], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(shingle: int):
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return of


def _rotations(distance: int) -> list[tuple[int, int]]:
    """(left rotation, length) of each block that leads once."""
    cuts = [BITS * i // (distance + 1) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def walk_pairs(leaves: np.ndarray, depth: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of sorted distinct 64-bit leaves that agree in the first ``depth`` bits and link.

    The sorted leaves are the trie: a node is a range of them. All node pairs of one depth are taken a step
    down together.
    """
    n = len(leaves)
    empty = np.zeros(0, np.int64)
    if n < 2:
        return empty, empty
    head = leaves >> np.uint64(BITS - depth)
    first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
    last = np.concatenate([first[1:], [n]])
    wide = last - first > 1
    a, b = first[wide], last[wide]
    c, d = a.copy(), b.copy()
    error = np.zeros(len(a), np.int64)
    found_i, found_j = [], []
    for level in range(depth, BITS + 1):
        # two single leaves: the rest of their paths is compared at once
        one = (b - a == 1) & (d - c == 1)
        i, j = a[one], c[one]
        near = (i != j) & (_bits(leaves[i] ^ leaves[j]) <= distance)
        found_i.append(i[near])
        found_j.append(j[near])
        a, b, c, d, error = (x[~one] for x in (a, b, c, d, error))
        if not len(a) or level == BITS:
            break
        bit = np.uint64(BITS - 1 - level)
        ones = np.concatenate([[0], np.cumsum((leaves >> bit) & np.uint64(1)).astype(np.int64)])
        mid_ab = b - (ones[b] - ones[a])
        mid_cd = d - (ones[d] - ones[c])
        same = a == c
        steps = [
            (a, mid_ab, c, mid_cd, error, np.ones(len(a), bool)),
            (mid_ab, b, mid_cd, d, error, np.ones(len(a), bool)),
            (a, mid_ab, mid_cd, d, error + 1, np.ones(len(a), bool)),
            (mid_ab, b, c, mid_cd, error + 1, ~same),
        ]
        kept = []
        for p, q, r, s, e, ok in steps:
            ok = ok & (e <= distance) & (q > p) & (s > r) & ~((p == r) & (q - p == 1))
            kept.append((p[ok], q[ok], r[ok], s[ok], e[ok]))
        a, b, c, d, error = (np.concatenate(x) for x in zip(*kept))
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    return np.minimum(i, j), np.maximum(i, j)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest of its component, in place of all links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _walk(distance: int):
    """Edges within the groups of leaves below pairs of nodes; the rows of a group arrive together."""
    lengths = [length for _, length in _rotations(distance)]

    def edges(turn: int, leaves: np.ndarray) -> pd.DataFrame:
        leaves = np.sort(leaves)
        i, j = walk_pairs(leaves, lengths[turn], distance)
        u, v = _forest(len(leaves), i, j)
        back = _turned(leaves.view(np.int64), BITS - _rotations(distance)[turn][0])
        return pd.DataFrame({"a": back[u], "b": back[v]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            turns, groups, leaves = (frame[c].to_numpy() for c in ("turn", "pair", "leaf"))
            cuts = [0, *(np.flatnonzero((groups[1:] != groups[:-1]) | (turns[1:] != turns[:-1])) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                yield edges(int(turns[a]), leaves[a:b].view(np.uint64))
            # the last group may go on in the next batch
            held = frame.iloc[cuts[-1] :]
        if held is not None and len(held):
            yield edges(int(held["turn"].iloc[0]), held["leaf"].to_numpy().view(np.uint64))

    return run


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    """Signed 64-bit numbers rotated left."""
    if by % BITS == 0:
        return x
    u = x.view(np.uint64)
    return ((u << np.uint64(by)) | (u >> np.uint64(BITS - by))).view(np.int64)


def _turn(x: Column, by: int) -> Column:
    return x if by == 0 else F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, BITS - by))


def _masks(bits: int, errors: int) -> list[int]:
    """Numbers of so many bits with at most so many set."""
    return [sum(1 << b for b in at) for k in range(errors + 1) for at in combinations(range(bits), k)]


def linked(leaves: DataFrame, distance: int = DISTANCE, walk: int = WALK, step: int = STEP) -> DataFrame:
    """Edges (a, b) over the distinct values of column ``fp`` that connect what the links connect."""
    turns = _rotations(distance)
    spark = leaves.sparkSession
    spun = cut(
        leaves.select(
            F.explode(
                F.array(*[F.struct(F.lit(k).alias("turn"), _turn(F.col("fp"), by).alias("leaf")) for k, (by, _) in enumerate(turns)])
            ).alias("x")
        ).select("x.*")
    )

    def node(level: int) -> Column:
        """The path of a leaf so many rounds below its block."""
        out = F.when(F.lit(False), F.lit(0).cast("long"))
        for k, (_, length) in enumerate(turns):
            out = out.when(F.col("turn") == k, F.shiftrightunsigned("leaf", BITS - min(length + level * step, BITS)))
        return out

    def bits(level: int) -> Column:
        """How many bits a round takes the paths of a turn down."""
        out = F.lit(0)
        for k, (_, length) in enumerate(turns):
            out = F.when(F.col("turn") == k, min(length + level * step, BITS) - min(length + (level - 1) * step, BITS)).otherwise(out)
        return out

    blocks = spun.groupBy("turn", node(0).alias("a")).agg(F.count("*").alias("n")).where("n > 1")
    pairs = cut(blocks.select("turn", "a", F.col("a").alias("b"), F.lit(0).alias("error"), "n"))
    own = spun.withColumn("node", node(0))
    groups, ends = [], []
    level = 0
    while True:
        small = pairs.where(F.col("n") <= walk)
        sides = F.array_distinct(F.array("a", "b"))
        asked = small.select("turn", F.xxhash64("turn", "a", "b", F.lit(level)).alias("pair"), F.explode(sides).alias("node"))
        groups.append(own.join(asked, ["turn", "node"]).select("turn", "pair", "leaf"))
        large = pairs.where(F.col("n") > walk)
        if level and all(length + level * step >= BITS for _, length in turns):
            break  # nodes are leaves: their pairs are in ``ends``
        if large.isEmpty():
            break
        level += 1
        # children of the nodes that are too large, with the numbers of their leaves
        parents = large.select("turn", F.explode(F.array("a", "b")).alias("up")).distinct()
        below = spun.withColumns({"up": node(level - 1), "node": node(level)})
        children = cut(below.join(parents, ["turn", "up"], "left_semi").groupBy("turn", "up", "node").agg(F.count("*").alias("n")))
        first = large.join(children.select("turn", F.col("up").alias("a"), F.col("node").alias("ca"), F.col("n").alias("na")), ["turn", "a"])
        own_bits = bits(level)
        flips = F.filter(F.array(*[F.lit(m).cast("long") for m in _masks(step, distance)]), lambda m: (F.bit_count(m) <= distance - F.col("error")) & (m < F.call_function("shiftleft", F.lit(1).cast("long"), own_bits)))
        low = F.col("ca") - F.call_function("shiftleft", F.col("a"), own_bits)
        reached = first.select(
            "turn", "ca", "na", (F.col("a") == F.col("b")).alias("same"), "error", "b", low.alias("low"), own_bits.alias("bits"), F.explode(flips).alias("flip")
        ).select(
            "turn", "ca", "na", "same", (F.col("error") + F.bit_count("flip")).alias("error"),
            (F.call_function("shiftleft", F.col("b"), F.col("bits")) + F.col("low").bitwiseXOR(F.col("flip"))).alias("cb"),
        )
        met = reached.where("not same or ca <= cb").join(children.select("turn", F.col("node").alias("cb"), F.col("n").alias("nb")), ["turn", "cb"])
        total = F.when(F.col("ca") == F.col("cb"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        pairs = cut(met.select("turn", F.col("ca").alias("a"), F.col("cb").alias("b"), "error", total.alias("n")).where("n > 1"))
        own = spun.withColumn("node", node(level))
        # where a turn's nodes are leaves, their pairs are links
        at_end = [k for k, (_, length) in enumerate(turns) if length + level * step >= BITS]
        if at_end:
            done = pairs.where(F.col("turn").isin(at_end) & (F.col("a") != F.col("b")))
            for k in at_end:
                back = BITS - turns[k][0] if turns[k][0] else 0
                ends.append(done.where(F.col("turn") == k).select(_turn(F.col("a"), back).alias("a"), _turn(F.col("b"), back).alias("b")))
            pairs = pairs.where(~F.col("turn").isin(at_end))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = groups[0]
    for g in groups[1:]:
        rows = rows.unionByName(g)
    out = rows.repartition(n, "turn", "pair").sortWithinPartitions("turn", "pair").mapInPandas(_walk(distance), "a long, b long")
    for e in ends:
        out = out.unionByName(e)
    return out


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(id, key, fp, label): each row's id, the hash of its text, its fingerprint and its component's smallest fingerprint."""
    own = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    marked = cut(own.select("id", F.xxhash64("text").alias("key"), fingerprints(shingle)("text").alias("fp")))
    labels = components(linked(marked.select("fp").distinct(), distance))
    labels = labels.withColumnRenamed("node", "fp")
    return marked.join(labels, "fp", "left").select("id", "key", "fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: its id, fingerprint (16 hex digits) and component_id, the smallest id reachable."""
    rows = cut(grouped(docs, doc_id, text, shingle, distance))
    # cut, so that the join stands alone and adaptive execution may split a hot label
    least = cut(rows.groupBy("label").agg(F.min("id").alias("component_id")))
    return rows.join(least, "label").select(
        F.col("id").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def filter_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents, one of each component: that with the smallest id (null ids last), then text hash; once if repeated."""
    rows = grouped(docs, doc_id, text, shingle, distance)
    kept = rows.groupBy("label").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "key")).alias("first")).select("first.id", "first.key")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = whole.select("row", F.col(f"row.`{doc_id}`").alias("id"), F.xxhash64(F.col(f"row.`{text}`")).alias("key"))
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.key") == F.col("r.key"))
    found = own.alias("l").join(kept.alias("r"), same, "left_semi")
    return found.dropDuplicates(["id", "key"]).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(scan(spark, sf_dir, "documents"))


QUERIES = {"op3_simhash": query}
