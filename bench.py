"""Time the headline queries and print one line of JSON.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. Each query is
built and run in full, its rows thrown away by Spark's ``noop`` sink; the first run warms up and
the median of the other ``$BENCH_RUNS`` (default 3) is reported.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from nodeledger.registry import catalog

HEADLINE = (
    "clean_jobs",
    "cleaning_audit",
    "queue_summary",
    "queue_efficiency",
    "queue_metric_stats",
    "size_walltime_grid",
    "job_size_histogram_by_slice",
    "scatter_points",
    "hour_distribution",
    "dayofyear_distribution",
    "monthly_core_hours",
    "core_hours_cumulative",
    "core_hours_scope",
    "daily_core_hours_by_month",
    "nodes_in_use",
    "utilization_stats",
    "utilization_stats_by_slice",
    "utilization_rolling",
    "utilization_trend",
    "over_capacity_jobs",
    "jobs_running_at",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("nodeledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "total_median_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": int(cpus),
        "spark": spark.version,
        "shuffle_partitions": int(cpus),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
