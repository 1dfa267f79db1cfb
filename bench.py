"""Time the registered queries.

    BENCH_SF_DIR   parquet folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local[N] cores (default 8)
    BENCH_RUNS     timed runs per query (default 3; the median is reported)
    BENCH_QUERIES  comma-separated subset (default: all)
    BENCH_SHUFFLE_PARTITIONS  initial shuffle partitions (default: one per core)

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected). One untimed warm-up run per query comes
first. Prints one JSON line:

    {"metric": "total_median_sec", "value": N, "unit": "sec",
     "queries": {"q": sec, ...}, "spread": {"q": [min, max], ...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from stockyard import registry  # noqa: E402
from stockyard.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    default_parts = int(cpus) if cpus.isdigit() else 8
    spark = local_session(
        cores=cpus,
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", default_parts)),
        app_name="stockyard-bench",
        driver_memory="16g",
    )
    names = only or list(registry.QUERIES)
    times: dict[str, float] = {}
    spread: dict[str, list[float]] = {}
    for name in names:
        fn = registry.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
        spread[name] = [round(min(samples), 4), round(max(samples), 4)]
    match = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_median_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "spread": spread,
        "runs": runs,
        "cpus": cpus,
        "sf": float(match.group(1)) if match else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
