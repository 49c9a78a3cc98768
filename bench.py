"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.registry import runnable  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "product_demand",
    "clickstream_silver",
    "cart_pricing",
    "cart_totals",
    "catalog_page",
    "best_sellers",
    "latest_reviews",
    "order_history",
    "supplier_demand",
    "checkout_batch",
    "checkout_points",
    "orders_usd",
    "loyalty_members",
    "attribution",
    "orders_mirror",
    "orders_as_of",
    "sync_changes",
    "sync_mode",
    "constraint_report",
    "query_patterns",
    "working_set",
    "silver_stream",
    "continuous_sync_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        run = runnable(name)
        best = None
        for _ in range(3):
            start = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
