"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores.
Each query runs once to warm up, then BENCH_RUNS times (default 3); the median counts. Every
run builds the plan anew and evaluates all rows and columns into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.queries import QUERIES
from martwright.session import get_session

HEADLINE = [
    "clean_keys_dedupe",
    "silver_customer",
    "silver_sales_header",
    "silver_sales_detail",
    "dim_date",
    "scd2_second_load",
    "scd2_customer_history",
    "upsert_scd1",
    "fact_order",
    "fact_product_daily",
    "fact_seller_daily",
    "fact_order_daily",
    "fact_inventory",
    "fact_customer_behavior",
    "incremental_order_daily",
    "affected_customer_recompute",
    "q_sales_kpis",
    "q_daily_trend",
    "q_aov_by_type",
    "q_top_products",
    "q_revenue_by_country",
    "q_stock_vs_sales",
    "q_segment_summary",
    "q_top_regions",
    "q_rfm_scatter",
    "q_top_sellers",
    "q_category_by_country",
    "x_abc_class",
    "build_summary",
    "incremental_stored_runs",
    "x_stream_incremental",
]

LOADS = {"build_summary", "incremental_stored_runs", "x_stream_incremental"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    medians = {}
    for name in HEADLINE:
        seconds(name)
        # the whole loads take long and vary little: one measured run
        medians[name] = round(statistics.median(seconds(name) for _ in range(1 if name in LOADS else runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline query seconds, summed medians",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
