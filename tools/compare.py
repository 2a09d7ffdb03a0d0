"""Time the library's forms of a query against the plain ones: `python tools/compare.py <folder> [copies]`.

Works on the layer tables built from the folder. `copies` repeats bronze with shifted zones, so
that keys stay apart, to see how times grow with the data. Prints one line of JSON per pair.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from operator import and_
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from faremill import build_session, plans  # noqa: E402
from faremill import operators as ops  # noqa: E402
from faremill.contracts import DEDUP_KEY, SECONDARY_FIELDS, TRIP_CONTRACT  # noqa: E402
from faremill.sinks import write_table  # noqa: E402
from workload.queries import lakehouse  # noqa: E402

RUNS = 3


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median(job: Callable[[], object]) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def counts(df: DataFrame, conditions: list) -> None:
    """One action per condition and one for the total."""
    df.count()
    for c in conditions:
        df.filter(c).count()


def pairs(spark: SparkSession, cfg: plans.LakehouseConfig) -> dict[str, tuple[Callable, Callable]]:
    bronze, silver, gold = (spark.table(cfg.table(n)) for n in (cfg.bronze_name, cfg.silver_name, cfg.gold_name))
    people, amount = F.col("passenger_count"), F.col("total_amount")
    anomalies = {"zero": people == 0, "still": F.col("trip_distance") == 0, "null": people.isNull(), "neg": amount < 0}
    interaction = [people.isNull() & (amount > 0), (people == 0) & (amount > 0), (amount <= 0) & (people > 0)]
    ranked = Window.partitionBy(*DEDUP_KEY).orderBy("etl_ingestion_timestamp")
    keeps = {"time": ops.in_time_order(), "window": cfg.valid.contains("tpep_pickup_datetime")}
    absent = [F.col(c).isNull() for c in SECONDARY_FIELDS]

    def rules_one_by_one() -> None:
        counts(bronze, [~keeps["time"], ~keeps["window"]])
        bronze.withColumn("_rn", F.row_number().over(ranked)).filter("_rn > 1").count()
        bronze.filter(keeps["time"] & keeps["window"]).withColumn("_rn", F.row_number().over(ranked)).filter(
            "_rn = 1"
        ).count()

    return {
        "anomaly counters": (
            lambda: counts(bronze, list(anomalies.values())),
            lambda: run(ops.anomaly_counts(bronze, anomalies)),
        ),
        "simultaneous NULLs": (
            lambda: (bronze.filter(absent[0]).count(), bronze.filter(reduce(and_, absent)).count()),
            lambda: run(ops.simultaneous_nulls(bronze)),
        ),
        "filter interaction": (
            lambda: counts(silver, interaction),
            lambda: run(ops.filter_interaction(silver)),
        ),
        "repeats": (
            lambda: (
                bronze.count(),
                bronze.withColumn("_rn", F.row_number().over(ranked)).filter("_rn > 1").count(),
            ),
            lambda: run(ops.duplicate_count(bronze)),
        ),
        "rule waterfall": (rules_one_by_one, lambda: run(ops.cleaning_waterfall(bronze, keeps, {}))),
        "chargeback impact": (
            lambda: run(ops.chargeback_impact(silver)),
            lambda: run(ops.chargeback_impact_one_pass(silver)),
        ),
        "one month's hours": (
            lambda: run(plans.avg_passengers_by_hour(plans.gold(plans.silver(bronze, cfg.valid)), 1996, 5)),
            lambda: run(plans.avg_passengers_by_hour(gold, 1996, 5)),
        ),
    }


def main() -> None:
    sf_dir, copies = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = build_session(
        "compare",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "16",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cfg = lakehouse(spark, sf_dir)
    if copies > 1:
        once = spark.table(cfg.table(cfg.bronze_name))
        many = once.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
            "PULocationID", F.col("PULocationID") + F.col("_copy") * 1000
        )
        cfg = replace(cfg, bronze_name=f"taxi_bronze_{copies}")
        write_table(many.drop("_copy"), cfg.table(cfg.bronze_name), TRIP_CONTRACT, "repeated")
    for name, job in {"build silver": plans.build_silver, "build gold": plans.build_gold}.items():
        start = time.perf_counter()
        job(spark, cfg)
        print(json.dumps({"job": name, "copies": copies, "seconds": round(time.perf_counter() - start, 3)}), flush=True)
    for name, (plain, ours) in pairs(spark, cfg).items():
        print(json.dumps({"query": name, "copies": copies, "plain": median(plain), "ours": median(ours)}), flush=True)


if __name__ == "__main__":
    main()
