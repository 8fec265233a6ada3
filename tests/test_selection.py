"""Exact ranks, samples and splits, against sorting in memory."""

import random

import pytest
from pyspark.sql import functions as F

from qloom.operators import selection


def group_rows():
    rnd = random.Random(3)
    out = [("hot", 7.0 if i % 3 == 0 else rnd.random() * 100) for i in range(4000)]
    out += [("ties", float(i % 3)) for i in range(11)]
    out += [("one", 5.0), ("four", 1.0), ("four", 2.0), ("four", 3.0), ("four", 4.0)]
    out += [(None, float(i)) for i in range(10)] + [("nulls", None), ("nulls", 2.0)]
    out += [("wide", rnd.lognormvariate(0, 8)) for _ in range(3000)]
    return out


def test_percentiles_are_positional(spark):
    rows = group_rows()
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = selection.rank_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p00": 0.0})
    want = {}
    for g in {g for g, _ in rows}:
        values = sorted(v for h, v in rows if h == g and v is not None)
        want[g] = tuple(values[int(len(values) * q)] for q in (0.5, 0.95, 0.0))
    assert {r.g: (r.p50, r.p95, r.p00) for r in got.collect()} == want
    assert want["four"][0] == 3.0


def test_percentiles_without_groups_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert tuple(selection.rank_percentiles(df, [], "v", {"p50": 0.5}).first()) == (50.0,)
    grouped = spark.createDataFrame([], "g string, v double")
    assert selection.rank_percentiles(grouped, ["g"], "v", {"p50": 0.5}).count() == 0


def test_approximate_percentiles(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    row = selection.rank_percentiles(df, ["g"], "v", {"p50": 0.5}, approximate=True).first()
    assert abs(row.p50 - 50) <= 1


@pytest.fixture(params=["merge", "counted"])
def path(request, monkeypatch):
    """Run the small and the large way of taking the first rows on the same data."""
    if request.param == "counted":
        monkeypatch.setattr(selection, "SMALL", -1)


def test_first_n(spark, path):
    ids = [i * i - 5000 for i in range(3000)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    for n in (1, 10, 2999, 3000, 9000):
        got = sorted(r.id for r in selection.first_n(df, "id", n).collect())
        assert got == sorted(ids)[:n]


def test_first_n_over_all_of_64_bits(spark, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 3)
    rnd = random.Random(8)
    ids = [-(2**63), 2**63 - 1, 0, -1, 1] + [rnd.randrange(-(2**63), 2**63) for _ in range(200)] + list(range(500, 900))
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for n in (4, 100, 300, 604, 605):
        got = sorted(r.id for r in selection.first_n(df, "id", n).collect())
        assert got == sorted(ids)[:n]


def test_equal_and_null_keys_give_exactly_n_rows(spark, path):
    same = spark.createDataFrame([(7, k % 3) for k in range(20)], "id long, x int").repartition(4)
    for take in (selection.first_n, selection.sample):
        got = sorted(r.x for r in take(same, "id", 5).collect())
        assert len(got) == 5 and len(take(same, "id", 20).collect()) == len(take(same, "id", 30).collect()) == 20
    some = spark.createDataFrame([(i, 0) for i in [None] * 5 + list(range(10))], "id long, x int").repartition(4)
    got = [r.id for r in selection.first_n(some, "id", 12).collect()]
    assert sorted(i for i in got if i is not None) == list(range(10)) and got.count(None) == 2
    assert selection.sample(some, "id", 12).count() == 12 and selection.sample(some, "id", 0).count() == 0


def test_both_ways_take_the_same_rows(spark, monkeypatch):
    df = spark.createDataFrame([(k // 4, k) for k in range(200)], "id long, x int").repartition(3)
    ways = []
    for small in (10_000, -1):
        monkeypatch.setattr(selection, "SMALL", small)
        ways.append([{r.x for r in take(df, "id", n).collect()} for take in (selection.first_n, selection.sample) for n in (1, 50, 101)])
    assert ways[0] == ways[1]


@pytest.mark.parametrize("kind", ["int", "long", "float", "double", "decimal(9,3)", "date", "timestamp"])
def test_percentiles_of_all_number_types(spark, kind):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.randrange(-9000, 9000) / 7,) for _ in range(301)] + [(-0.0,), (0.0,)], "v double")
    text = {"date": "date_add(date'2000-01-01', cast(v as int))", "timestamp": "timestamp_micros(cast(v * 1e9 as long))"}
    df = df.selectExpr(f"{text.get(kind, f'cast(v as {kind})')} AS v").repartition(3)
    values = sorted(r.v for r in df.collect())
    got = selection.rank_percentiles(df, [], "v", {"a": 0.0, "b": 0.31, "c": 0.99}).first()
    assert tuple(got) == tuple(values[int(len(values) * q)] for q in (0.0, 0.31, 0.99))


def test_nothing_runs_before_the_result_is_asked_for(spark):
    df = spark.range(10).select(F.col("id"), F.raise_error(F.lit("ran")).cast("double").alias("v"))
    selection.rank_percentiles(df, ["id"], "v", {"a": 0.5})
    selection.split(df, "id")
    selection.held_out_sample(df, "id", 3)
    selection.first_n(df, "id", 10**6)


def test_sample_does_not_depend_on_partitions(spark, path):
    df = spark.range(500)
    a = {r.id for r in selection.sample(df.repartition(3), "id", 40).collect()}
    b = {r.id for r in selection.sample(df.coalesce(1), "id", 40).collect()}
    c = {r.id for r in selection.sample(df, "id", 40, seed=7).collect()}
    assert len(a) == len(c) == 40 and a == b and a != c


@pytest.mark.parametrize("n, held", [(0, 0), (1, 1), (100, 6), (233, 12), (1000, 51)])
def test_split_is_whole_and_disjoint(spark, n, held):
    """The test part is ceil(n * (1 - 0.95)) in double arithmetic, so 100 rows give 6."""
    df = spark.range(n)
    rows = selection.split(df.repartition(4), "id").collect()
    assert sorted(r.id for r in rows) == list(range(n))
    test = {r.id for r in rows if r.split == "test"}
    assert len(test) == held
    again = {r.id for r in selection.split(df.coalesce(1), "id").collect() if r.split == "test"}
    assert test == again


def test_copies_of_an_id_stay_on_one_side(spark):
    df = spark.createDataFrame([(i,) for i in list(range(60)) + [17] * 30], "id long")
    rows = selection.split(df, "id", train_fraction=0.7).collect()
    assert len(rows) == 90
    assert len({r.split for r in rows if r.id == 17}) == 1


def test_no_held_out_part(spark):
    assert selection.split(spark.range(5), "id", train_fraction=1.0).where("split = 'test'").count() == 0


def test_held_out_sample_is_part_of_the_test_rows(spark):
    df = spark.range(400)
    test = {r.id for r in selection.split(df, "id").where("split = 'test'").collect()}
    got = {r.id for r in selection.held_out_sample(df, "id", 15).collect()}
    assert len(test) == 21 and len(got) == 15 and got < test
    assert {r.id for r in selection.held_out_sample(df, "id", 99).collect()} == test
