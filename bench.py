"""Time the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job runs once to warm up and then three times; the median counts. A run
writes the whole result to the ``noop`` sink, so no column can be pruned away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from kgloom.registry import JOBS
from kgloom.session import build_session

HEADLINE = [
    "build_edges",
    "build_edges_ordered",
    "build_nodes",
    "predicate_mappings",
    "endpoint_check",
    "connected_nodes",
    "sample_edges_substring",
    "sample_nodes_substring",
    "sample_edges_exact",
    "superfluous_value_counts",
    "value_counts",
    "bool_to_labels",
    "fix_delimiter",
    "keep_first",
    "merge_edges_fold",
    "merge_edges_fast",
    "merge_nodes",
    "rewrite_endpoints",
    "rewrite_endpoints_both",
    "normalize_categories",
    "clean_graph_edges",
    "generation_spec_values",
    "id_prefixes",
    "json_lookup",
    "list_repeats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:32} first {times[0]:6.2f}  median {seconds[name]:6.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
