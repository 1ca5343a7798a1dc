"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma-separated query names, to time a selection
"""

from __future__ import annotations

import json
import os
import time

from delaynet.plans.catalog import QUERIES
from delaynet.session import build_session, release
from delaynet.sources.tables import table

HEADLINE = [
    "route_edges", "hub_attribution", "fairness", "top_keys", "dedup_keep_first", "dedup_audit", "normalize_row",
    "hll_vs_exact", "cms_vs_exact", "cms_width_sweep", "bloom_dedup", "dp_epsilon_sweep", "k_anonymity",
    "similar_routes", "exact_jaccard_join", "pagerank", "pagerank_trade", "connected_components", "components_trade",
    "data_quality", "throughput_windows", "stream_dedup",
]


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to produce every row, without moving them to the driver."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=str(cores),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = table(spark, sf_dir, "lineitem").count()
    run(spark, "route_edges", sf_dir)  # start-up cost of the JVM is not a query's
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
        "lineitem_rows": rows,
    }
    if "stream_dedup" in seconds:
        result["stream_rows_per_sec"] = round(rows / seconds["stream_dedup"], 1)
    release(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
