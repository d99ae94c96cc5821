"""Time the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The first query runs once to warm the session up; each query is then timed ``$BENCH_RUNS``
times (the median counts). Results go to Spark's no-op sink, so that all rows are computed and
none are collected. Arguments choose other queries than the headline ones; ``all`` takes every
registered one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.registry import queries
from skyledger.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

HEADLINE = [
    "clean_flights", "clean_flights_dedup", "data_quality", "bi_flights", "daily_mart",
    "dim_time", "dim_airports", "dim_delays", "fact_table", "fact_table_with_ids",
    "table_info", "table_summary", "delays_by_year", "top_airlines", "top_routes",
    "monthly_trends", "day_of_week", "cancellation_analysis", "report_outputs",
    "specific_routes", "airlines_sample", "random_sample_year", "partitioned_roundtrip",
    "load_tolerant_csv", "flatten_flight", "stream_foreach_batch",
]


def seconds(query, spark) -> float:
    started = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session("bench", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
    }, f"local[{CPUS}]")
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    chosen = sys.argv[1:] or HEADLINE
    if chosen == ["all"]:
        chosen = list(registered)
    seconds(registered[chosen[0]], spark)
    times = {}
    for name in chosen:
        runs = [seconds(registered[name], spark) for _ in range(RUNS)]
        times[name] = round(statistics.median(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
