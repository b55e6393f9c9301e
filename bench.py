"""Headline-query timings: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is collected once to warm the JVM (codegen, class loading), then
timed ``BENCH_REPS`` times (median reported). All numbers are ours; the
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorecraft.plans.registry import QUERIES  # noqa: E402
from scorecraft.session import get_spark  # noqa: E402

HEADLINE = ["iv_report", "contingency", "describe_numeric", "chi_square", "correlation_matrix", "vif",
            "csi_report", "bin_performance", "csi_summary", "band_psi", "ks", "ks_table", "accuracy_summary",
            "classification_report"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    times = {}
    for n in names:
        QUERIES[n](spark, sf_dir).collect()  # warm-up
        ts = []
        for _ in range(reps):
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).collect()
            ts.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(ts), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
