"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from marlstone.session import build_session
from marlstone.workload.queries import QUERIES

HEADLINE = [
    "slv_customers", "slv_orders", "slv_order_items", "dq_metrics_order_items",
    "dedup_lineitem", "messy_dates", "explode_installments", "dim_customer", "scd2_customer",
    "point_in_time_join", "fct_sales", "mv_revenue_daily", "mv_sales_by_category",
    "mv_sales_by_state", "mv_order_funnel", "mv_review_summary", "kpi_pareto",
    "mask_email_analyst", "stream_dedup", "incremental_refresh", "medallion_run",
]

# The median of so many runs counts; the long full run is timed once.
RUNS = 3
ONCE = {"medallion_run"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Python call sites in error messages cost time at every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start-up is not part of a query

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    timed("slv_customers")  # nor is compiling code for the first time
    seconds = {}
    for name in names:
        runs = [timed(name) for _ in range(1 if name in ONCE else RUNS)]
        seconds[name] = round(statistics.median(runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
