import re

import corpus_pipeline
from qloom.llm import decontamination, line_dedup, packing, quality_rules, simhash
from qloom.llm.shared import shared_folder
from qloom.sources.tables import scan
from tests.llm import frames
from tests.llm.test_simhash import naive_components, naive_fingerprint


def test_stages_in_order_equal_brute_force(spark, sf_dir):
    docs = scan(spark, sf_dir, "documents")
    items = [r["text"] for r in scan(spark, sf_dir, "benchmark").collect()]
    folder = shared_folder(spark, "stages")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if k < 4:
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in before.schema]
        kept[name] = docs
    texts = lambda name: {r["doc_id"]: r["text"] for r in kept[name].collect()}
    judged = {r["doc_id"] for r in quality_rules.query(spark, sf_dir).where("kept").collect()}
    quality, lines, near, clean = (texts(n) for n, _ in corpus_pipeline.STAGES[:4])
    assert set(quality) == judged
    # line dedup keeps every row, and each line somewhere
    assert set(lines) == set(quality)
    assert {x for t in quality.values() for x in t.split("\n")} | {""} == {x for t in lines.values() for x in t.split("\n")} | {""}
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"].collect())
    # near duplicates: the smallest id of each component
    marks = {i: naive_fingerprint(t) for i, t in lines.items()}
    label = naive_components(sorted(set(marks.values())), 2)
    first = {}
    for i in sorted(marks):
        first.setdefault(label[marks[i]], i)
    assert set(near) == set(first.values())
    flat = lambda t: " ".join(t.lower().split())
    assert set(clean) == {i for i, t in near.items() if not any(flat(x) in flat(t) for x in items)}
    pieces = kept["packing"].collect()
    assert {r["doc_id"] for r in pieces} == set(clean)


def test_run_writes_and_reads_every_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_stages_bear_odd_rows_and_empty_tables(spark, sf_dir):
    for docs in (frames.odd(spark, clashing=True), frames.nothing(spark)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns or k == 4
            assert out.count() <= max(docs.count(), 0) or k == 4


def test_operators_are_the_numbered_ones():
    names = [f.__module__ for _, f in corpus_pipeline.STAGES]
    assert names == ["corpus_pipeline"] * 5
    source = open(corpus_pipeline.__file__).read()
    for part in (quality_rules, line_dedup, simhash, decontamination, packing):
        assert re.search(rf"\b{part.__name__.rsplit('.', 1)[1]}\.\w+\(", source)


def test_every_query_is_registered():
    import __spark_entry__ as entry
    from qloom.llm import queries

    named = {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES}
    assert named == set(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
