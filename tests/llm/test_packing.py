import zlib
from itertools import combinations

import numpy as np
import pytest

from qloom.llm import packing as q
from qloom.llm.tokens import Encoder, vocabulary_path
from tests.llm import frames


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


ODD_WORDS = ["don't DON'T it's. 'S. x'll!!", "ΣΑΣ Σ. İstanbul ǅ", "5.5% 10,000. ½. 漢字。漢字. 3rd", "<|endoftext|> a<|endoftext|>b", "é. ́ x́! …foo…. naïve.&&& ---", "a\x1cb c\x85d", "STRASSE Straße ﬁ ªº µ"]


@pytest.mark.parametrize("text", [t for _, t in frames.ODD] + ODD_WORDS)
def test_ids_equal_the_tokenizers(tokenizer, text):
    encoder = Encoder()
    for _ in range(2):
        assert encoder.ids(text).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def total(places, fees, length, chosen):
    cost, before = 0, 0
    for p in chosen:
        if p - before > length:
            return None
        cost += length - (p - before) + fees[p]
        before = p
    return cost


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(150):
        n = int(rng.integers(1, 10))
        places = np.cumsum(rng.integers(1, 6, n))
        penalties = rng.integers(0, 5, n)
        fees = dict(zip(places.tolist(), penalties.tolist()))
        length = 8
        end = int(places[-1])
        best = min(c for r in range(n) for s in combinations(places[:-1].tolist(), r) if (c := total(places, fees, length, [*s, end])) is not None)
        assert total(places, fees, length, q.cuts(places, penalties, length)) == best


def check(rows, docs, tokenizer, end, length):
    """Pieces cover every document once and every sequence from 0 on."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
    for doc_id, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        by_doc.setdefault(doc_id, []).append(ids)
    for doc_id, several in by_doc.items():
        own = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == doc_id)
        want_crc = set()
        for start, n, crc, total_ids in own:
            assert any(len(ids) == total_ids and zlib.crc32(ids[start : start + n].tobytes()) == crc for ids in several)
            want_crc.add(crc)
        assert sum(n for _, n, _, _ in own) == sum(map(len, several))


def test_odd_rows(spark, tokenizer):
    rows = q.pack(frames.odd(spark)).collect()
    check(rows, frames.ODD, tokenizer, q.END, q.LENGTH)


@pytest.mark.parametrize("length,buffer", [(64, 64), (100, 1000), (7, 30)])
def test_small_windows_and_buffers(spark, tokenizer, length, buffer):
    docs = [(k, "One sentence here. " * (k % 9) + "x" * (k % 5)) for k in range(60)]
    rows = q.pack(frames.documents(spark, docs), length=length, buffer=buffer).collect()
    check(rows, docs, tokenizer, q.END, length)
    order = sorted((r["sequence_id"], r["offset"], r["doc_id"], r["start"]) for r in rows)
    assert [x[2:] for x in order] == sorted(x[2:] for x in order)


def test_empty_table(spark):
    assert q.pack(frames.nothing(spark)).count() == 0


def test_query_has_little_padding(spark, sf_dir, tokenizer):
    from qloom.sources.tables import scan

    rows = q.query(spark, sf_dir).collect()
    docs = [(r["doc_id"], r["text"]) for r in scan(spark, sf_dir, "documents").collect()]
    check(rows, docs, tokenizer, q.END, q.LENGTH)
    used = sum(r["length"] for r in rows)
    # the last window of each task is cut short
    full = max(r["sequence_id"] for r in rows) + 1 - 8
    assert used / (full * q.LENGTH) > 0.97
