"""Time the headline queries on local cores and print one line of JSON.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the cores.  Each query is
built and run in full, all columns, as the median of three runs after one that
warms up the JVM.

``queries`` starts from the order tables, so every query also pays for the
joins that build the sales fact.  ``stored_fact`` starts from the fact as a
stored table, the way the marts are built from loaded sales.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.plans.catalog import REPORTS, portable, queries  # noqa: E402
from salesmart.session import local_session  # noqa: E402
from salesmart.sources.harness import sales_from_orders  # noqa: E402

HEADLINE = [
    "stg_transactions",
    "daily_revenue",
    "daily_revenue_weekend_split",
    "category_performance",
    "top_items_ranked",
    "payment_split",
    "venue_summary_default",
    "top_items",
    "monthly_trend",
    "monthly_trend_all_years",
    "fct_venue_performance",
    "visit_history",
    "visit_history_by_customer",
    "fct_retention",
    "dq_summary",
    "source_tests",
]
FROM_STORED = ["daily_revenue", "fct_venue_performance", "visit_history", "fct_retention", "dq_summary"]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    registered = queries()

    def seconds(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def timed(build) -> float:
        seconds(build)
        return round(statistics.median(seconds(build) for _ in range(RUNS)), 3)

    times = {name: timed(lambda: registered[name](spark, sf_dir)) for name in HEADLINE}

    path = os.path.join(tempfile.mkdtemp(prefix="salesmart-bench-"), "sales.parquet")
    fact = sales_from_orders(spark, sf_dir)
    fact.write.parquet(path)
    stored = spark.read.schema(fact.schema).parquet(path)
    stored_times = {name: timed(lambda: portable(REPORTS[name](stored))) for name in FROM_STORED}
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stored_fact": stored_times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
