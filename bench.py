"""Time the headline queries at $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from edgeloom.operators.triangles import triangle_work  # noqa: E402
from edgeloom.plans import graphs  # noqa: E402
from edgeloom.plans.catalogue import EDGES_PER_TRIPLE, QUERIES  # noqa: E402

HEADLINE = [
    "edge_scan",
    "edge_parse_lines",
    "max_filter",
    "follower_count",
    "degree_in_out",
    "distinct_edges",
    "adjacency_list",
    "path2_cardinality",
    "path2_pairs",
    "path2_pairs_broadcast",
    "path2_pairs_blocks",
    "closed_walks_hops",
    "closed_walks_semi_hops",
    "closed_walks_set_hops",
    "triangle_count",
    "triangle_count_hops",
    "triangle_count_broadcast",
    "triangle_count_partition",
    "triangle_count_intersect",
    "dangling_nodes",
    "pagerank",
    "pagerank_hops",
    "pagerank_dangling_trace",
    "pagerank_chain",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("edgeloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="edgeloom-bench-"))
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # One untimed query starts the JVM's code paths for all of them.
    QUERIES["follower_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        result = QUERIES[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    # Rows that the ways to count triangles shuffle.
    work = triangle_work(graphs.hops(spark, sf_dir), EDGES_PER_TRIPLE).first().asDict()
    spark.stop()
    report = {
        "metric": "total_wall_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "triangle_work_hops": work,
        "sf": Path(sf_dir).name,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
