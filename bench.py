"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from etalage.plans import catalog  # noqa: E402

HEADLINE = [
    "daily_revenue",
    "top_products",
    "top_categories",
    "suspicious_payments",
    "orders_details",
    "paid_revenue_total",
    "orphan_counts",
    "payments_curated",
    "order_items_priced",
    "payment_order_nearest",
    "positional_link",
    "dedup_latest",
    "dq_unique",
    "dq_reconcile",
    "gdpr_erase",
    "fraud_alerts_build",
    "fraud_rule_metrics",
    "fraud_features",
    "cep_fail_then_success",
    "rfm_segments",
    "cohort_retention",
    "conversion_funnel",
    "utm_attribution",
    "sessionize",
    "customer_360",
    "category_pairs",
    "revenue_grains",
    "stream_tumbling_5min",
    "stream_sessions",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    # Warm the JVM: the first query otherwise pays for class loading.
    catalog.run("top_categories", spark, path).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.run(name, spark, path).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(path.rstrip("/")),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
