"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed to the last row; the best of
$BENCH_REPEATS runs counts. The metric is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import re
import time
from functools import partial

from orderloom.plans.registry import QUERIES
from orderloom.session import release_scratch, spark_session

HEADLINE = [
    "stg_orders_clean",
    "stg_order_items_clean",
    "stg_customers_clean",
    "stg_products_clean",
    "dim_customer_upsert",
    "dim_product_upsert",
    "fact_orders_upsert",
    "fact_order_items_upsert",
    "mart_daily_sales",
    "mart_top_parts",
    "mart_top_parts_k",
    "mart_margin_by_category",
    "mart_cohort_retention",
    "mart_cohort_retention_full",
    "mart_rfm_segments",
    "dq_fact_order_items_missing_fk",
    "dq_order_sum_mismatch",
    "contract_checks",
    "run_audit_latest",
    "batch_daily_sales",
]


def run(name: str, spark, folder: str) -> None:
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def seconds(step) -> float:
    start = time.perf_counter()
    step()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = spark_session(
        f"local[{cpus}]",
        "orderloom-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # Small files: split them finer than a cluster would, so that every core scans.
            "spark.sql.files.openCostInBytes": str(1024 * 1024),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    timings = {}
    for name in HEADLINE:
        step = partial(run, name, spark, folder)
        step()
        timings[name] = round(min(seconds(step) for _ in range(repeats)), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
