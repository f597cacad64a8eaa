"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "stg_campaigns", "stg_routes", "stg_route_employee", "stg_visits", "stg_responses",
    "mart_campaign_performance", "mart_visit_responses",
    "kpi_portfolio_totals", "kpi_worker_status",
    "check_unique", "check_relationships", "profile_cardinality", "profile_outliers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = sys.argv[1:] or HEADLINE
    for name in names:  # compile and warm up
        run(name)
    seconds = {name: min(run(name), run(name)) for name in names}
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
