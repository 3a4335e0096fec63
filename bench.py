"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is forced with a ``noop`` write (full computation, nothing
collected to the driver), ``BENCH_RUNS`` times after one warm-up query; the
reported time is the median, the first (cold) run is reported separately.  ``all_metrics`` runs the seven metric tables into a
fresh store (the ETL write path); ``seven_separate`` is the sum of the seven
single-metric times for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulseboard.queries import QUERIES  # noqa: E402
from pulseboard.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# one shuffle partition per core at this size; AQE coalesces further (cluster: size by data, see README)
SHUFFLE_PARTITIONS = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", CPUS if CPUS.isdigit() else "8"))  # value = sum of per-query medians; first runs reported apart

HEADLINE = [
    "platform_metrics", "device_breakdown", "transport_comparison", "sdk_versions", "failure_analysis",
    "latency_percentiles", "timeseries_all",
    "platform_metrics_hourly", "realtime_funnel", "match_funnel", "match_rollup_platform",
    "jobs_join_events", "backfill_platform", "accumulate_upsert", "job_validation",
]
SEVEN = HEADLINE[:7]


def _sf(path: str) -> float | str:
    tail = os.path.basename(path)
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def main() -> None:
    spark = local_session(cpus=CPUS, shuffle_partitions=SHUFFLE_PARTITIONS, app="pulseboard-bench")
    # warm-up (JVM, codegen caches), not counted
    QUERIES["platform_metrics"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE + ["all_metrics_store"]:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        key = "all_metrics" if name == "all_metrics_store" else name
        cold[key] = round(runs[0], 3)
        times[key] = round(statistics.median(runs), 3)
    times["seven_separate"] = round(sum(times[q] for q in SEVEN), 3)
    total = round(sum(v for k, v in times.items() if k != "seven_separate"), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "cold_first_run": cold, "runs_per_query": RUNS,
                      "sf": _sf(SF_DIR)}))
    spark.stop()


if __name__ == "__main__":
    main()
