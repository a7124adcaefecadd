"""Headline queries, timed.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Every query runs once to warm up and then
five times; the median counts. Prints one JSON line.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checkmart.operators.versions import check_final_close, final_versions, positive_qty  # noqa: E402
from checkmart.registry import QUERIES  # noqa: E402
from checkmart.sources import adapters  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))



def final_versions_join_form(spark, sf_dir):
    """Final versions by aggregate and join: two scans, for comparison with the window."""
    raw = adapters.raw_checks_from_orders(spark, sf_dir)
    last = check_final_close(raw).withColumnRenamed("final_close_ts", "close_ts")
    return positive_qty(raw).join(last, ["check_id", "close_ts"])


def final_versions_window_form(spark, sf_dir):
    """The same by the library's operator."""
    return final_versions(adapters.raw_checks_from_orders(spark, sf_dir))


COMPARISON = {f.__name__: f for f in (final_versions_join_form, final_versions_window_form)}

HEADLINE = [
    "final_versions",
    "final_versions_join_form",
    "final_versions_window_form",
    "fact_check_items_orders",
    "mart_plan_fact_daily",
    "mart_channel_daily",
    "mart_avg_check_by_order_type",
    "mart_dish_sales_daily",
    "mart_dashboard_daily",
    "cancelled_checks",
    "dim_dish",
    "dim_date",
    "top_dishes",
    "period_kpis",
    "assign_row_ids",
    "incremental_fact_refresh",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("checkmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {**QUERIES, **COMPARISON}
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
