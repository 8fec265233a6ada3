import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from qloom.llm import simhash as q
from qloom.llm.components import components
from tests.llm import frames


def naive_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def naive_components(values, distance):
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {v: root(v) for v in values}


@pytest.mark.parametrize("text", [t for _, t in frames.ODD] + ["ÀB c\x85d É", "A a A a A", "x y", "THE Σ cat sat on the mat the cat sat on the mat"])
def test_fingerprint_by_definition(text):
    assert q.fingerprint(text) & (1 << 64) - 1 == naive_fingerprint(text)


def clustered(seed, n, spread):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.int64)
    out = {0, 3, -1}
    for _ in range(n):
        v = int(centres[rng.integers(0, 6)])
        for b in rng.integers(0, 64, rng.integers(0, spread + 1)):
            v ^= 1 << int(b)
        out.add((v + (1 << 63)) % (1 << 64) - (1 << 63))
    return sorted(out)


@pytest.mark.parametrize("distance,walk", [(2, 4096), (2, 1), (2, 20), (1, 4096), (1, 4), (3, 4096), (3, 6), (0, 4096), (0, 1)])
def test_components_equal_brute_force(spark, distance, walk):
    values = clustered(distance * 10 + walk, 250, 5)
    want = naive_components([v & (1 << 64) - 1 for v in values], distance)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r["node"]: r["label"] for r in components(q.linked(frame, distance, walk)).collect()}
    groups, expected = {}, {}
    for v in values:
        groups.setdefault(got.get(v, v), set()).add(v & (1 << 64) - 1)
    for v, r in want.items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_walk_gives_exactly_the_linked_pairs():
    leaves = np.sort(np.array([v for v in clustered(5, 400, 4)], np.int64).view(np.uint64))
    block = leaves >> np.uint64(64 - 21)
    i, j = q.walk_pairs(leaves, 21, 2)
    want = {(a, b) for a in range(len(leaves)) for b in range(a + 1, len(leaves)) if block[a] == block[b] and int(leaves[a] ^ leaves[b]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_blocks_that_run_over_arrow_batches(spark):
    # one block; the two differing bits of a pair lie in both others, so that no other rotation finds it
    rng = np.random.default_rng(3)
    alone = [int(x) for x in rng.integers(0, 1 << 42, 60)]
    values = sorted({*alone, *(x ^ (1 << (22 + k % 20)) ^ (1 << (k % 22)) for k, x in enumerate(alone))})
    want = naive_components(values, 2)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        frame = spark.createDataFrame([(v,) for v in values[1::2] + values[::2]], "fp long")
        got = {r["node"]: r["label"] for r in components(q.linked(frame)).collect()}
    finally:
        spark.conf.set(size, before)
    assert {v: got.get(v, v) for v in values} == want


@pytest.mark.parametrize("size", [1, 7, 50])
def test_walk_over_batches_gives_the_components_of_one(size):
    rng = np.random.default_rng(size)
    values = rng.permutation(np.unique(rng.integers(0, 1 << 14, 300) << 9 | rng.integers(0, 4, 300) << 40))
    rows = pd.DataFrame({"turn": 0, "pair": values >> 40, "leaf": values}).sort_values("pair", kind="stable")
    batches = [rows[k : k + size] for k in range(0, len(rows), size)]

    def edges(frames):
        found = pd.concat(q._walk(2)(iter(frames)))
        return q._forest(len(values), *(np.searchsorted(np.sort(values), found[c].to_numpy()) for c in "ab"))

    for got, want in zip(edges(batches), edges([rows])):
        assert got.tolist() == want.tolist()


def test_a_crowded_block_among_others(spark):
    # a block of 900 leaves is taken down as rows, the others are walked at once
    rng = np.random.default_rng(9)
    crowd = [int(x) for x in rng.integers(0, 1 << 30, 450)]
    values = sorted({*crowd, *(x ^ (1 << int(rng.integers(0, 30))) for x in crowd), *(int(x) for x in rng.integers(-(1 << 62), 1 << 62, 200))})
    want = naive_components([v & (1 << 64) - 1 for v in values], 2)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r["node"]: r["label"] for r in components(q.linked(frame, walk=100)).collect()}
    groups, expected = {}, {}
    for v in values:
        groups.setdefault(got.get(v, v), set()).add(v & (1 << 64) - 1)
    for v, r in want.items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_chain_of_nodes(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


def test_odd_rows(spark):
    rows = q.near_duplicates(frames.odd(spark)).collect()
    assert len(rows) == len(frames.ODD)
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, 8, None} and {r["component_id"] for r in zero} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (6, 7)} == {6}
    big = [r for r in rows if r["doc_id"] == (1 << 60) + 1]
    assert [r["component_id"] for r in big] == [(1 << 60) + 1]


def test_filter_keeps_one_of_each_group(spark):
    docs = frames.odd(spark)
    kept = q.filter_documents(docs)
    assert kept.schema == docs.schema
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    want = [(1, frames.ODD[0][1]), (2, None), (5, "One"), (5, "Another text under the same id"), (None, "Text without an id."), (6, frames.LONG), ((1 << 60) + 1, frames.ODD[11][1]), (-9, "below zero")]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert q.near_duplicates(frames.nothing(spark)).count() == 0
    assert q.filter_documents(frames.nothing(spark)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    from qloom.sources.tables import scan

    docs = {r["doc_id"]: naive_fingerprint(r["text"]) for r in scan(spark, sf_dir, "documents").collect()}
    label = naive_components(sorted(set(docs.values())), 2)
    least = {}
    for i, f in docs.items():
        least[label[f]] = min(i, least.get(label[f], i))
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in q.query(spark, sf_dir).collect()}
    assert got == {(i, f"{f:016x}", least[label[f]]) for i, f in docs.items()}
