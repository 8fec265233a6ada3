"""Properties of the physical plans of the named queries."""

import pathlib

import pytest

import __spark_entry__ as entry
from qloom.plans import QUERIES

ROOT = pathlib.Path(entry.__file__).parent


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text


def test_year_filter_reaches_the_files(spark, sf_dir):
    text = plan(QUERIES["filter_year"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["group_sum"](spark, sf_dir))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text


def test_top_k_merges_partial_results(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, sf_dir))
    assert "WindowGroupLimit" in plan(QUERIES["retain_last_k"](spark, sf_dir))


@pytest.mark.parametrize("name", ["feat_status", "involved_tables", "catalog_columns", "format_alpaca_prompt"])
def test_row_local_jobs_add_no_shuffle(spark, sf_dir, name):
    """Beyond the one that spreads the parts, or the two of the join that pairs the turns."""
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Exchange") <= (2 if name == "format_alpaca_prompt" else 1)
    assert "ENSURE_REQUIREMENTS" not in text or name == "format_alpaca_prompt"


def test_ngrams_are_not_shuffled(spark, sf_dir):
    """Above the join that pairs the turns, only the counts per label are exchanged."""
    text = plan(QUERIES["bleu4"](spark, sf_dir))
    above = text[: text.index("Join")]
    assert above.count("Exchange hashpartitioning(label") == 1 and above.count("Exchange") == 1


def test_report_reads_its_rows_once_per_use(spark, sf_dir):
    text = plan(QUERIES["eval_report"](spark, sf_dir))
    assert text.count("Checkpoint") == 0 and "LogicalRDD" not in text and "Scan ExistingRDD" not in text


def test_sources_hold_no_local_checkpoint():
    for path in (ROOT / "qloom").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint(" not in text and "crossJoin(" not in text and ".rdd" not in text, path


@pytest.mark.parametrize("name", ["spend_discounted_top_k", "anti_join_bridge"])
def test_details_shrink_to_the_wanted_orders_in_their_scan(spark, sf_dir, name):
    """With shuffled joins and thresholds for small tables, the filter of the orders is tested on the other side's scan."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in text and text.index("might_contain") < text.rindex("l_orderkey")
