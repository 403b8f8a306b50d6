"""Time the named queries: one JSON line on standard output.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default: all), ``BENCH_RUNS`` (default 3, the
median counts), ``BENCH_QUERIES`` (names, or ``all``; default: the headline set). Every query runs
in full and its rows go to Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oreflow.queries import all_queries  # noqa: E402
from oreflow.session import local_session, scratch_scope  # noqa: E402

HEADLINE = [
    "gold_daily_sales",
    "silver_sales",
    "gold_product_sales",
    "inventory_status",
    "dedupe_by_key",
    "monthly_sales",
    "star_products",
    "quarter_growth",
    "seasonal_baseline",
    "silver_transactions",
    "gold_daily_risk",
    "fraud_features",
    "suspicious_transactions",
    "signal_lift",
    "auc_exact",
    "quality_metrics",
    "pii_scan",
    "scd2",
    "ingest_incremental",
    "silver_stream",
    "versioned_update",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if wanted == "all" else wanted.split() or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus), app="oreflow-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        with scratch_scope(spark):
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - began

    once("gold_daily_sales")  # start the JVM's code paths
    timings = {name: round(statistics.median(once(name) for _ in range(runs)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
