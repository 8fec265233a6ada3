import random

import pytest

from qloom.llm import line_dedup as q
from tests.llm import frames


def test_patience_matches_are_common_and_rise():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(30))]
        b = a[:]
        for _ in range(rng.randrange(5)):
            if b:
                b[rng.randrange(len(b))] = rng.randrange(12)
        b = b[: rng.randrange(31)]
        found = q._matches(a, b)
        assert all(a[i] == b[k] for i, k in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def test_equal_sides_match_whole_and_moved_lines_once():
    assert q._matches([1, 1, 2], [1, 1, 2]) == [(0, 0), (1, 1), (2, 2)]
    assert q._matches([1, 2, 3, 9], [9, 1, 2, 3]) == [(0, 1), (1, 2), (2, 3)]


def test_blocks_need_words():
    assert q.blocks([1, 2, 5, 3], [30, 25, 9, 60], [1, 2, 7, 3], 50) == [(0, 0, 2, 55), (3, 3, 1, 60)]
    assert q.blocks([1, 2, 5, 3], [30, 25, 9, 49], [1, 2, 7, 3], 56) == []


def line(k, n=60):
    return " ".join(f"w{k}x{j}" for j in range(n))


def texts(rows):
    return {(r["doc_id"], r["text"]) for r in rows.collect()}


def test_later_documents_lose_shared_blocks(spark):
    passage = f"{line(1, 30)}\n{line(2, 30)}"
    docs = frames.documents(spark, [(1, f"own one\n{passage}"), (2, f"{passage}\nown two\nshort"), (3, f"a\n{line(1, 30)}\nb\n{line(2, 30)}"), (4, "short")])
    got = texts(q.deduplicate(docs, n_chars="n_chars"))
    # document 3 holds the lines apart, too short a block each
    assert got == {(1, f"own one\n{passage}"), (2, "own two\nshort"), (3, f"a\n{line(1, 30)}\nb\n{line(2, 30)}"), (4, "short")}
    lengths = {r["doc_id"]: r["n_chars"] for r in q.deduplicate(docs, n_chars="n_chars").collect()}
    assert lengths[2] == len("own two\nshort")


def test_frequent_lines_are_found_like_rare_ones(spark):
    docs = frames.documents(spark, [(k, f"{line(7)}\nonly {k}") for k in range(40)])
    assert texts(q.deduplicate(docs)) == {(0, f"{line(7)}\nonly 0")} | {(k, f"only {k}") for k in range(1, 40)}
    assert q.aligned_blocks(docs).select("id").distinct().count() == 39


def test_block_whose_lines_have_different_first_holders(spark):
    a, b = line(1, 30), line(2, 30)
    docs = frames.documents(spark, [(1, a), (2, b), (3, f"{a}\n{b}\nthree"), (4, f"{a}\n{b}\nfour")])
    assert (4, "four") in texts(q.deduplicate(docs)) and (3, f"{a}\n{b}\nthree") in texts(q.deduplicate(docs))


def test_passage_whose_frequent_lines_have_other_first_holders(spark):
    a, b, c = line(1, 30), line(2, 30), line(3, 10)
    rows = [(1, a), (2, b), (3, c)] + [(k, f"{a}\n{b}\n{c}\nonly {k}") for k in range(4, 24)]
    assert texts(q.deduplicate(frames.documents(spark, rows))) == {*rows[:4], *((k, f"only {k}") for k in range(5, 24))}


@pytest.mark.parametrize("first,later", [("ab ab", "ab"), ("ab", "ab ab"), ("ab cd", "cd ab"), ("abab", "baba"), ("ab cd ab", "cd abx ab cd")])
def test_repeated_and_swapped_passages(first, later):
    words = {k: 30 for k in map(ord, "abcdx")} | {ord(" "): 2}
    a, b = [*map(ord, later)], [*map(ord, first)]
    found = q.blocks(a, [words[x] for x in a], b, 50)
    held = {k for i in range(len(a)) for j in range(i, len(a)) if sum(words[x] for x in a[i : j + 1]) >= 50 and later[i : j + 1] in first for k in range(i, j + 1)}
    assert {k for start, _, n, _ in found for k in range(start, start + n)} == held
    assert all(a[i : i + n] == b[k : k + n] and w == sum(words[x] for x in a[i : i + n]) for i, k, n, w in found)


def test_deleted_lines_are_those_in_runs_that_an_earlier_document_holds(spark):
    rng = random.Random(11)
    pool = [line(k, rng.choice([5, 20, 30, 55])) for k in range(6)]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randrange(1, 12)))) for k in range(60)]
    want, before = set(), []
    for k, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                part = lines[i : j + 1]
                if len(" ".join(part).split()) >= 50 and any(part == other[m : m + len(part)] for other in before for m in range(len(other))):
                    gone.update(range(i, j + 1))
        want.add((k, "\n".join(x for m, x in enumerate(lines) if m not in gone)))
        before.append(lines)
    assert texts(q.deduplicate(frames.documents(spark, rows))) == want


def test_no_line_vanishes(spark):
    rng = random.Random(5)
    pool = [line(k, rng.choice([5, 20, 55, 80])) for k in range(40)]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randrange(1, 9)))) for k in range(120)]
    kept = {x for _, t in texts(q.deduplicate(frames.documents(spark, rows))) for x in t.split("\n")}
    assert {x for _, t in rows for x in t.split("\n")} <= kept


def test_every_long_line_of_an_earlier_document_goes(spark):
    rng = random.Random(6)
    pool = [line(k, 55) for k in range(60)]
    rows = [(k, "\n".join(rng.sample(pool, 3)) + f"\nown {k}") for k in range(60)]
    found = {r["id"] for r in q.aligned_blocks(frames.documents(spark, rows)).select("id").distinct().collect()}
    seen, want = set(), set()
    for k, t in rows:
        if seen & set(t.split("\n")):
            want.add(k)
        seen |= set(t.split("\n"))
    assert found == want


def test_odd_rows(spark):
    docs = frames.odd(spark)
    out = q.deduplicate(docs, n_chars="n_chars", min_words=1)
    assert out.schema == docs.schema and out.count() == len(frames.ODD)
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert (7, "") in got and (6, frames.LONG) in got and (2, None) in got and (3, "") in got
    assert got.count((5, "One")) == 2


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty_tables(spark, rows):
    docs = frames.documents(spark, rows)
    assert q.deduplicate(docs).count() == len(rows)
    assert q.aligned_blocks(docs).count() == 0


def test_a_document_that_loses_very_many_lines(spark):
    import time

    lines = [f"line {k} has six words here" for k in range(60_000)]
    docs = frames.documents(spark, [(1, "\n".join(lines)), (2, "\n".join(["first words"] + lines + ["last words"]))])
    start = time.perf_counter()
    got = {r["doc_id"]: r["text"] for r in q.deduplicate(docs).collect()}
    assert got == {1: "\n".join(lines), 2: "first words\nlast words"}
    assert time.perf_counter() - start < 60


def test_short_lines_that_many_documents_share_pair_nothing(spark, monkeypatch):
    docs = [(k, f"Home\nAbout us\nown words of document {k} " + " ".join(f"w{k}x{j}" for j in range(60)) + "\nAll rights reserved") for k in range(40)]
    aligned = []
    real = q.blocks
    monkeypatch.setattr(q, "blocks", lambda *a: aligned.append(1) or real(*a))
    assert q.aligned_blocks(frames.documents(spark, docs)).count() == 0
    # pairs are made before the alignment: none is left for it
    plan_rows = q.aligned_blocks(frames.documents(spark, docs + [(50, docs[3][1])])).select("id", "ref").distinct().collect()
    assert [tuple(r) for r in plan_rows] == [(50, 3)]
