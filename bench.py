"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local threads. Each query runs to a sink that
reads every row and column of its result; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from qloom.plans import QUERIES
from qloom.session import session

HEADLINE = (
    "spend_discounted_top_k",
    "spend_top_k",
    "join_path_chain",
    "join_star",
    "join_group_sum",
    "group_count_distinct",
    "anti_join_direct",
    "anti_join_bridge",
    "group_sum",
    "filter_conjunction",
    "top_k",
    "train_test_split",
    "format_chat_prompt",
    "render_conversations",
    "length_profile",
    "exact_match",
    "bleu4",
    "eval_report",
    "latency_percentiles",
    "metric_latest",
    "retain_last_k",
    "serving_rollup",
    "catalog_columns",
    "join_edges",
    "join_paths",
    "feat_comparisons",
    "shape_profile",
    "resolvability_rate",
    "sql_drafts",
)


def seconds(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(
        "qloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    taken = {name: round(min(seconds(spark, name, sf) for _ in range(2)), 3) for name in names}
    scale = re.search(r"sf([\d.]+)", sf)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "sf": float(scale.group(1)) if scale else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
