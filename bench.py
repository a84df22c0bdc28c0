"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 3).
Each query runs on a fresh pipeline state (no memoised snapshots), fully executed through the
``noop`` sink (no collect); the reported number is the median of BENCH_REPEAT runs after one
warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.plans import catalog, state  # noqa: E402
from stratum.session import local_session  # noqa: E402

HEADLINE = ["dedup_latest", "scd1_merge", "scd2_apply", "fact_merge", "json_array_flatten", "point_in_time",
            "campaign_performance", "fact_event", "dq_summary_meta"]


def run_once(spark, sf: str, key: str) -> float:
    state.clear(delete_files=True)   # fresh pipeline state; vacuum the previous run's snapshots
    t0 = time.perf_counter()
    catalog.QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, checkpoint_dir=scratch + "/ckpt")
    for k in HEADLINE:  # warm-up: JIT, file listing caches
        run_once(spark, sf, k)
    times = {}
    for k in HEADLINE:
        times[k] = round(statistics.median(run_once(spark, sf, k) for _ in range(repeat)), 3)
    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    state.clear(delete_files=True)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf_name, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
