"""Benchmark: `BENCH_SF_DIR=… BENCH_CPUS=… python bench.py` prints one line of JSON.

Each query is run to the end into the no-op sink: once to warm up, then three times, of which
the median counts. The layer jobs write their tables once, as a pipeline does, and the
`table_*` queries read those.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parent))

from faremill import build_session, plans  # noqa: E402
from faremill import operators as ops  # noqa: E402
from workload.queries import QUERIES, lakehouse  # noqa: E402
from workload.trips import ANSWER_MONTH, YEAR, land  # noqa: E402

HEADLINE = (
    "revenue_by_month",
    "revenue_report",
    "avg_passengers_by_hour",
    "hours_wide",
    "silver_build",
    "gold_build",
    "dedup_first",
    "duplicate_count",
    "duplicate_examples",
    "cleaning_waterfall",
    "null_profile",
    "null_by_vendor",
    "anomaly_counts",
    "negative_total_by_payment",
    "out_of_range_profile",
    "completeness",
    "monthly_profile",
    "chargeback_impact",
    "payment_distribution",
    "scan_periods",
    "schema_drift",
    "bronze_build",
)
RUNS = 3


def once(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(make: Callable[[], DataFrame]) -> float:
    once(make)
    return statistics.median(once(make) for _ in range(RUNS))


def timed(job: Callable[[], object]) -> tuple[float, object]:
    start = time.perf_counter()
    result = job()
    return time.perf_counter() - start, result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    land(spark, sf_dir)
    seconds = {name: median(lambda name=name: QUERIES[name](spark, sf_dir)) for name in HEADLINE}

    seconds["job_bronze"], cfg = timed(lambda: lakehouse(spark, sf_dir))
    seconds["job_silver"], _ = timed(lambda: plans.build_silver(spark, cfg))
    seconds["job_gold"], _ = timed(lambda: plans.build_gold(spark, cfg))
    bronze, silver, gold = (spark.table(cfg.table(n)) for n in (cfg.bronze_name, cfg.silver_name, cfg.gold_name))
    tables = {
        "table_revenue_by_month": lambda: plans.revenue_by_month(gold),
        "table_revenue_report": lambda: plans.revenue_report(gold),
        "table_avg_passengers_by_hour": lambda: plans.avg_passengers_by_hour(gold, YEAR, ANSWER_MONTH),
        "table_null_profile": lambda: ops.null_profile(bronze),
        "table_duplicate_count": lambda: ops.duplicate_count(bronze),
        "table_completeness": lambda: ops.completeness(silver),
        "table_filter_interaction": lambda: ops.filter_interaction(silver),
        "table_chargeback_impact_one_pass": lambda: ops.chargeback_impact_one_pass(silver),
    }
    seconds |= {name: median(make) for name, make in tables.items()}
    print(
        json.dumps(
            {
                "metric": "trip_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
