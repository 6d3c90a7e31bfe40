"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the input and the number of cores.  Each
query runs to the end into a sink that discards the rows; the time is the best
of BENCH_RUNS runs and includes building the plan.  Queries on the star find it
written; ``star_build`` times building and writing it.
"""

from __future__ import annotations

import json
import os
import time

from checks import stars
from checks.catalog import QUERIES
from tallymart.plans.star import build_star
from tallymart.session import local_session
from tallymart.sources.shared import shared_dir
from tallymart.sources.star import write_warehouse

HEADLINE = [
    "fact_orders_build", "dim_customer_build", "dim_product_build", "dim_date_build",
    "warehouse_validation", "kpi_retention", "kpi_revenue_per_customer",
    "kpi_revenue_by_category", "kpi_monthly_trend", "kpi_channel_monthly", "aq_product_margin",
    "aq_segment_churn", "aq_channel_failure", "aq_category_recommendation", "aq_top_customers",
    "aq_category_mix", "api_executive_kpis", "api_customer_segments", "insights_all",
    "dashboard_payload",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench", cpus)

    def build() -> None:
        write_warehouse(
            build_star(stars.raw(spark, sf_dir, "graded")), shared_dir(spark, "bench")
        )

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {"star_build": min(timed(build) for _ in range(runs))}
    for name in ("plain", "graded"):
        stars.star(spark, sf_dir, name)
    for name in HEADLINE:
        seconds[name] = min(timed(lambda: run(name)) for _ in range(runs))
    rounded = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
