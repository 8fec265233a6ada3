"""Metric, parameter and serving logs, in batch and as a stream."""

import datetime as dt
import random

import pytest

from qloom.operators import sketches, telemetry
from qloom.schemas import METRIC_LOG
from qloom.session import work_folder
from qloom.sources import committed
from qloom.sources.logs import append_metrics, read_metrics, write_report
from qloom.streaming.metrics import LATEST, compact_latest, latest_stream, metric_stream, read_latest, table_stream

T0 = dt.datetime(2024, 1, 1)


def log(n=3000, seed=4):
    """Random metric rows, a third of them in one series."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        run, key = ("r0", "loss") if i % 3 == 0 else (f"r{rnd.randrange(6)}", rnd.choice(["loss", "lr", "eval_loss"]))
        out.append((run, T0 + dt.timedelta(seconds=i), key, float(rnd.randrange(1000)), rnd.randrange(400)))
    return out


def latest(rows):
    out = {}
    for run, ts, key, value, step in rows:
        out[run, key] = max(out.get((run, key), (-1,)), (step, ts, value))
    return {k: (v[0], v[2]) for k, v in out.items()}


def as_dict(df):
    return {(r.run_id, r.key): (r.step, r.value) for r in df.collect()}


def test_latest(spark):
    rows = log()
    df = spark.createDataFrame(rows, METRIC_LOG).repartition(5)
    assert as_dict(telemetry.metric_latest(df)) == latest(rows)


def test_best_checkpoint_prefers_the_earlier_step(spark):
    rows = [("a", T0, "eval_loss", 2.0, 9), ("a", T0, "eval_loss", 1.0, 7), ("a", T0, "eval_loss", 1.0, 3),
            ("a", T0, "loss", 0.1, 1), ("b", T0, "eval_loss", None, 1), ("b", T0, "eval_loss", 5.0, 2)]
    got = telemetry.best_checkpoint(spark.createDataFrame(rows, METRIC_LOG))
    assert sorted(map(tuple, got.collect())) == [("a", 3, 1.0), ("b", 2, 5.0)]


def test_retain_last_k(spark):
    df = spark.createDataFrame([("a", s) for s in (5, 1, 9, 7)] + [("b", 1)], "run_id string, step long")
    assert sorted(map(tuple, telemetry.retain_last_k(df).collect())) == [("a", 7), ("a", 9), ("b", 1)]


def test_numeric_entries_only(spark):
    df = spark.createDataFrame([("r", T0, 1, {"loss": "0.5", "note": "fast", "n": "3", "gone": None})], "run_id string, ts timestamp, step long, e map<string,string>")
    got = telemetry.metric_numeric(df, "e").select("key", "value").collect()
    assert sorted(map(tuple, got)) == [("loss", 0.5), ("n", 3.0)]


def test_param_log(spark):
    df = spark.createDataFrame([("r", {"lr": "1"}, {"mods": ["q", "v"]})], "run_id string, p map<string,string>, l map<string,array<string>>")
    assert sorted(map(tuple, telemetry.param_log(df, "p", "l").collect())) == [("r", "lr", "1"), ("r", "mods", "q,v")]
    assert telemetry.param_log(df, "p").count() == 1


def test_serving_log(spark):
    df = spark.createDataFrame([(T0, "v1", "SELECT  a\nFROM t", 1.239)], "ts timestamp, model_version string, sql string, elapsed_ms double")
    row = telemetry.serving_log(df).first()
    assert (row.execution_time_ms, row.tokens_generated, row.sql) == (1.24, 4, "SELECT  a\nFROM t")


def test_serving_rollup(spark):
    df = spark.createDataFrame([("v1", 2.0, 3), ("v1", 4.0, None), ("v2", None, 1)], "model_version string, execution_time_ms double, tokens_generated int")
    got = {r.model_version: tuple(r)[1:] for r in telemetry.serving_rollup(df).collect()}
    assert got == {"v1": (2, 3.0, 3), "v2": (1, None, 1)}


def test_append_and_read(spark, tmp_path):
    rows = log(200)
    path = str(tmp_path / "metrics")
    df = spark.createDataFrame(rows, METRIC_LOG)
    append_metrics(df.where("step < 200"), path)
    append_metrics(df.where("step >= 200"), path)
    back = read_metrics(spark, path)
    assert back.count() == 200
    assert as_dict(telemetry.metric_latest(back)) == latest(rows)


def test_write_report(spark, tmp_path):
    path = str(tmp_path / "report")
    for _ in range(2):
        write_report(spark.createDataFrame([("new", 1.0)], "label string, bleu4 double"), path)
    assert [tuple(r) for r in spark.read.schema("label string, bleu4 double").json(path).collect()] == [("new", 1.0)]


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    rows = log(600)
    folder = tmp_path / "in"
    out = work_folder(spark, "stream-test")

    def run():
        stream = metric_stream(spark, str(folder), METRIC_LOG, files_per_batch=1)
        latest_stream(stream, f"{out}/table", f"{out}/state").awaitTermination()
        return as_dict(read_latest(spark, f"{out}/table"))

    for part in range(2):
        chunk = spark.createDataFrame(rows[part * 200 : (part + 1) * 200], METRIC_LOG)
        chunk.repartition(3).write.mode("append").parquet(str(folder))
    assert run() == latest(rows[:400])
    # late rows with old steps arrive after a restart
    spark.createDataFrame(rows[400:], METRIC_LOG).coalesce(1).write.mode("append").parquet(str(folder))
    assert run() == latest(rows)
    # nothing new: a further run changes nothing
    assert run() == latest(rows)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = log(100)
    path = str(tmp_path / "table")
    for batch, part in (("0", rows[:50]), ("1", rows[50:]), ("1", rows[50:])):
        df = spark.createDataFrame(part, METRIC_LOG).select("run_id", "key", "step", "ts", "value")
        new = batch not in committed.newest(spark, path).batches
        assert committed.append(df, path, batch) == new
    assert committed.newest(spark, path).number == 1 and committed.read(spark, path, LATEST).count() == 100
    assert as_dict(read_latest(spark, path)) == latest(rows)


def test_work_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert root is None or folder.startswith(root.rstrip("/"))


def test_cluster_needs_a_shared_folder():
    from qloom.session import checkpoint_root

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_steps_are_distinct_and_the_best_stays(spark):
    rows = [("a", s) for s in (10, 20, 20, 20, 5)] + [("b", 1), ("b", None)]
    df = spark.createDataFrame(rows, "run_id string, step long")
    assert sorted(map(tuple, telemetry.retain_last_k(df).collect())) == [("a", 10), ("a", 20), ("b", 1)]
    best = spark.createDataFrame([("a", 5), ("b", 1)], "run_id string, step long")
    assert sorted(map(tuple, telemetry.retain_last_k(df, best=best).collect())) == [("a", 5), ("a", 10), ("a", 20), ("b", 1)]


@pytest.mark.parametrize("parts", [1, 3])
def test_tables_of_one_file_and_of_many_stream_alike(spark, tmp_path, parts):
    import os

    rows = log(90)
    folder = tmp_path / "t.parquet"
    spark.createDataFrame(rows, METRIC_LOG).repartition(parts).write.parquet(str(folder))
    path = str(folder)
    if parts == 1:
        (file,) = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        path = f"{folder}/{file}"
    out = work_folder(spark, "table-stream")
    latest_stream(table_stream(spark, path), f"{out}/table", f"{out}/state").awaitTermination()
    assert as_dict(read_latest(spark, f"{out}/table")) == latest(rows)


def test_no_input_and_compaction(spark, tmp_path):
    rows = log(300)
    folder, out = tmp_path / "in", work_folder(spark, "compacted")
    folder.mkdir()

    def run():
        stream = metric_stream(spark, str(folder), METRIC_LOG)
        latest_stream(stream, f"{out}/table", f"{out}/state").awaitTermination()

    run()
    compact_latest(spark, f"{out}/table")
    assert read_latest(spark, f"{out}/table").count() == 0
    for part in range(3):
        chunk = rows[part * 100 : (part + 1) * 100]
        spark.createDataFrame(chunk, METRIC_LOG).coalesce(1).write.mode("append").parquet(str(folder))
        run()
        for _ in range(part):
            compact_latest(spark, f"{out}/table")
        assert as_dict(read_latest(spark, f"{out}/table")) == latest(rows[: (part + 1) * 100])


def test_an_append_that_broke_off_is_repeated_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [("a", T0, "loss", 1.0, 1), ("b", T0, "loss", 2.0, 2)]
    df = spark.createDataFrame(rows, METRIC_LOG)
    # a writer that broke off: rows in a folder that nobody committed
    df.write.partitionBy("run_id").parquet(f"{path}-batches/part=broken")
    assert read_metrics(spark, path).count() == 0
    for _ in range(3):
        append_metrics(df, path, "b1")
    append_metrics(df, path, "b2")
    assert sorted(tuple(r) for r in read_metrics(spark, path).select("run_id", "ts", "key", "value", "step").collect()) == sorted(rows * 2)
    # beside rows without a batch id
    append_metrics(df, path)
    assert read_metrics(spark, path).count() == 6
    assert committed.clean(spark, f"{path}-batches") == [] and committed.clean(spark, f"{path}-batches", -1) == ["part=broken"]
    assert read_metrics(spark, path).count() == 6


def test_two_writers_of_one_generation(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "k", 1, T0, 1.0)], LATEST)
    committed.append(df, path, "0")
    old = committed.newest(spark, path)
    # another writer commits between reading and committing
    calls = []

    def step(now):
        if not calls:
            calls.append(1)
            committed.append(df, path, "1")
        return {**now.folders, "part=x": ("2",)}

    df.write.parquet(f"{path}/part=x")
    done = committed.change(spark, path, step)
    assert done.batches == {"0", "1", "2"} and done.number == 2
    # a compaction of the older generation keeps what came since
    committed.replace(spark, path, old, df)
    assert committed.newest(spark, path).batches == {"0", "1", "2"} and committed.read(spark, path, LATEST).count() == 3
    # and does nothing where its folders were replaced already
    assert committed.replace(spark, path, old, df).number == 3


def test_readers_go_on_while_folders_are_replaced_and_cleaned(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    rows = log(120)
    for k in range(4):
        part = spark.createDataFrame(rows[k * 30 : k * 30 + 30], METRIC_LOG).select("run_id", "key", "step", "ts", "value")
        committed.append(part, path, str(k))
    begun = read_latest(spark, path)
    before = set(os.listdir(path))
    compact_latest(spark, path)
    assert committed.clean(spark, path, 3600) == []
    assert as_dict(begun) == latest(rows)
    gone = committed.clean(spark, path, 0)
    assert set(gone) == {f for f in before if f.startswith("part=")}
    assert sum(f.startswith("part=") for f in os.listdir(path)) == 1
    assert as_dict(read_latest(spark, path)) == latest(rows)
    assert committed.newest(spark, path).batches == {"0", "1", "2", "3"}
    # nothing is counted twice and no number used again
    assert not committed.append(spark.createDataFrame([], LATEST), path, "2")
    committed.append(spark.createDataFrame([("n", "k", 1, T0, 1.0)], LATEST), path, "4")
    assert committed.newest(spark, path).number == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_sketches_of_batches_are_within_their_bound(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 0.0, -3.5, round(rnd.expovariate(1 / 50), 3), rnd.random() * 10**rnd.randrange(6)])) for _ in range(900)]
    schema, path, by = "model_version string, ms double", str(tmp_path / "s"), "model_version string"
    for k in (0, 1, 1, 2):
        sketches.append_sketch(spark.createDataFrame(rows[k * 300 : k * 300 + 300], schema).repartition(3), path, str(k), ["model_version"], "ms")
        if k == 1:
            sketches.compact_sketch(spark, path, by)
    places = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = {r.model_version: r for r in sketches.sketch_percentiles(sketches.read_sketch(spark, path, by), ["model_version"], places).collect()}
    for version in ("a", "b", None):
        values = sorted(v for m, v in rows if m == version and v is not None)
        r = got[version]
        assert r.n_samples == len(values) and r.avg_latency_ms == pytest.approx(sum(values) / len(values), abs=1e-6)
        for name, q in places.items():
            true = values[int(len(values) * q)]
            assert abs(r[name] - true) <= abs(true) / 2**sketches.BITS + 1e-6


def test_empty_sketch(spark, tmp_path):
    path = str(tmp_path / "s")
    assert sketches.read_sketch(spark, path, "model_version string").count() == 0
    sketches.append_sketch(spark.createDataFrame([("a", None)], "model_version string, ms double"), path, "0", ["model_version"], "ms")
    assert sketches.read_sketch(spark, path, "model_version string").count() == 0
