import zlib

import numpy as np
import pytest

from qloom.llm import token_records as q
from qloom.llm.shared import open_in, open_out, shared_folder
from qloom.llm.tokens import vocabulary_path
from tests.llm import frames


def naive(docs, end=q.END):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    return [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4")) for i, t in docs]


def test_odd_rows_round_trip(spark):
    manifest = q.write_records(frames.odd(spark), shared_folder(spark, "records"), file_bytes=200)
    assert manifest.count() > 4
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in q.read_records(manifest).collect()]
    want = naive(frames.ODD)
    assert sorted(((i, n, c) for i, _, n, c in got), key=repr) == sorted(((i, len(x), zlib.crc32(x.tobytes())) for i, x in want), key=repr)
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    ids = [i for i, *_ in sorted(got, key=lambda r: r[1])]
    assert ids == [None, None] + sorted(i for i in ids if i is not None)


def test_shuffled_reads_through_the_index(spark):
    docs = [(k, f"document number {k}") for k in range(50)]
    manifest = q.write_records(frames.documents(spark, docs), shared_folder(spark, "records")).collect()
    want = dict(naive(docs))
    for r in manifest:
        order = np.random.default_rng(1).permutation(r["n_records"])
        found = list(q.read_file(r["path"], r["index"], order))
        whole = list(q.read_file(r["path"], r["index"]))
        assert [i for i, _ in found] == [whole[k][0] for k in order]
        assert all((ids == want[i]).all() for i, ids in found)


@pytest.mark.parametrize("at", [0, 5, 9, 14, 40, -2])
def test_damage_is_noticed(tmp_path, at):
    folder = f"file://{tmp_path}"
    data = q.frame(q.serialized(7, np.arange(20, dtype="<u2")))
    bad = bytearray(data)
    bad[at] ^= 1
    path, out = open_out(folder, "x")
    with out:
        out.write(bytes(bad))
    with open_in(path) as stream:
        with pytest.raises(ValueError):
            q.unframe(stream, 0, len(bad))
        with pytest.raises(ValueError):
            q.unframe(stream, 0, len(bad) - 3)


def test_wide_ids_and_missing_id():
    ids = np.array([70000, 1], "<u4")
    assert [x.tolist() if hasattr(x, "tolist") else x for x in q.deserialized(q.serialized(-5, ids))] == [-5, [70000, 1]]


def test_empty_table(spark):
    manifest = q.write_records(frames.nothing(spark), shared_folder(spark, "records"))
    assert manifest.count() == 0 and q.read_records(manifest).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    from qloom.sources.tables import scan

    docs = sorted((r["doc_id"], r["text"]) for r in scan(spark, sf_dir, "documents").collect())
    want, at = set(), 0
    for i, x in naive(docs):
        want.add((i, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert {tuple(r) for r in q.query(spark, sf_dir).collect()} == want
