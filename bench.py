"""Benchmark the headline jobs; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built from scratch and fully executed into Spark's ``noop``
sink (all rows computed, nothing collected); the median of BENCH_RUNS runs
(after one warm-up) is reported per query, and ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ambry.registry import QUERIES  # noqa: E402
from ambry.session import build_session  # noqa: E402

HEADLINE = [
    "p11_product_score",          # flagship: stages -> stats -> category -> score
    "p12_score_upsert",           # conditional upsert of the scores
    "p14_publish_batches",        # distributed row index + JSON batches
    "p1_sync_orders",             # incremental bronze sync with upsert
    "p2_sync_all",                # seven-table first load + audit rows
    "s2_order_invoice_transaction",
    "s5_business_stats",          # touched-key incremental fact
    "g3_agent_report",
    "g6_order_global_report",     # ten-link role-playing star join
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    spark = build_session(f"local[{cpus}]", app="ambry-bench", shuffle_partitions=partitions,
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for name in HEADLINE:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run is the warm-up
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
