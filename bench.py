"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into the ``noop`` sink (full execution, no
collect to the driver), from the source tables: no table is shared between
queries. Two untimed warm-up queries run first on sf0.001. Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnlens.queries import QUERIES  # noqa: E402
from churnlens.session import get_session  # noqa: E402

HEADLINE = [
    "clean_transactions",
    "validation_report",
    "customer_features_asof",
    "churn_labels",
    "customer_snapshots",
    "snapshot_report",
    "population_parity",
    "purchase_gap_percentile",
    "favourite_product",
    "temporal_split_counts",
    "pr_curve",
    "feature_drift_ks",
    "feature_drift_psi",
    "train_and_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="churnlens-bench", extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false",
        # small-data local run: let AQE keep shuffles spread over all cores
        # (on a cluster: parallelismFirst=false and a ~128 MB advisory size)
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    })
    # Warm the JVM (class loading, JIT, codegen cache) on the smallest tables,
    # untimed, so the timings measure the queries rather than compilation.
    for warm in ("customer_features_asof", "customer_snapshots"):
        QUERIES[warm](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
