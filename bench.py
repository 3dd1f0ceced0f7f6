"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row is produced,
nothing is collected to the driver), building its DataFrame from scratch each
time. A warm-up pass on sf0.001 runs first and is not timed; each query then
runs $BENCH_REPEAT times (default 2) and the best time is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickspan.plans import catalog  # noqa: E402
from tickspan.session import get_session  # noqa: E402

HEADLINE = [
    "dedup_latest_prices",
    "fact_performance_daily",
    "mart_active_performance",
    "period_summary",
    "benchmark_cumulative_return",
    "dim_date",
    "trading_calendar_bars",
    "watchlist_apply_changes",
    "dq_not_null",
    "json_series_flatten",
]


def run(spark, name, sf_dir):
    df = catalog.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", max(cpus, 8), app_name="tickspan-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for n in names:
            run(spark, n, warm)
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times = {}
    for n in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(spark, n, sf_dir)
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[n] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
