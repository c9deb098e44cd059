"""Times the headline queries and prints one JSON line.

Tables: $BENCH_SF_DIR (default sf0.1). Cores: $BENCH_CPUS (default 8).
Arguments, if any, name the queries to time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "degree_distribution",
    "graph_stats",
    "find_vertex_report",
    "word_count",
    "edge_list_space",
    "links_above_endpoint_means",
    "pagerank_10",
    "pagerank_tol",
    "label_propagation_5",
    "triangle_count",
    "clustering_coefficient",
    "maximal_matching_greedy",
    "maximal_matching_mpc",
    "maximal_matching_log_delta",
    "scored_matching_endpoint",
    "matmul_broadcast",
    "matmul_shuffle",
    "random_matrix",
    "with_row_index",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from edgeworks.plans import QUERIES

    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{d}/nation.parquet").count()
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.time()
        QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - started, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(d.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
