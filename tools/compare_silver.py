"""Time silver's two shuffles against one explicit distribution: `python tools/compare_silver.py <folder> [copies]`.

Both forms de-duplicate the same bronze rows of all years and write them by month. The first is the library's: the
window's shuffle by key, then the rebalance of the write. The second shuffles once by (year, month, bucket of the key), which
the window and the write both use. Each is timed without and with a key that holds a third of the rows. Prints a line of JSON
per run, with the files written and the largest one.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from faremill import PeriodRange, build_session, plans  # noqa: E402
from faremill import operators as ops  # noqa: E402
from faremill.contracts import DEDUP_KEY  # noqa: E402
from faremill.operators.clean import PICKUP  # noqa: E402
from workload.trips import ORDER, scratch, trips  # noqa: E402

RUNS = 3
BUCKETS = 4
WINDOW = PeriodRange.of(range(1992, 1999), range(1, 13))
MONTH = ["year", "month"]


def two_shuffles(bronze: DataFrame) -> DataFrame:
    return plans.silver(bronze, WINDOW, order=ORDER).hint("rebalance", *MONTH)


def one_shuffle(bronze: DataFrame) -> DataFrame:
    rows = ops.derive_calendar(bronze.filter(ops.in_time_order() & WINDOW.contains(PICKUP)))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*DEDUP_KEY), F.lit(BUCKETS))).repartition(*MONTH, "_bucket")
    ranked = Window.partitionBy(*MONTH, "_bucket", *DEDUP_KEY).orderBy(*ORDER)
    return rows.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn", "_bucket")


def bronze_rows(spark: SparkSession, sf_dir: str, copies: int, hot: bool) -> DataFrame:
    """The trips `copies` times with keys kept apart; with `hot`, every third row has the key of one trip."""
    rows = trips(spark, sf_dir).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    rows = rows.withColumn("PULocationID", F.col("PULocationID") + F.col("_copy") * 1000).drop("_copy")
    if hot:
        third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "PULocationID"), F.lit(3)) == 0
        start = F.lit("1995-05-05 05:00:00").cast("timestamp_ntz")
        same = dict(zip(DEDUP_KEY, [F.lit(1).cast("long"), start, start, F.lit(1).cast("long"), F.lit(1).cast("long")], strict=True))
        rows = rows.withColumns({c: F.when(third, v).otherwise(F.col(c)) for c, v in same.items()})
    path = scratch(spark)
    rows.repartition(64).write.parquet(path)
    return spark.read.parquet(path)


def files(spark: SparkSession, path: str) -> tuple[int, float]:
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    n, largest = sizes.agg(F.count("*"), F.max("length")).first()
    return n, round(largest / 1e6, 1)


def main() -> None:
    sf_dir, copies = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 10
    settings = {"spark.sql.shuffle.partitions": "64", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("compare-silver", "local[8]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    for hot in (False, True):
        bronze = bronze_rows(spark, sf_dir, copies, hot)
        for form in (two_shuffles, one_shuffle):
            for run in range(RUNS + 1):
                path, start = scratch(spark), time.perf_counter()
                form(bronze).write.partitionBy(*MONTH).parquet(path)
                took = round(time.perf_counter() - start, 2)
                n, largest = files(spark, path)
                print(json.dumps({"form": form.__name__, "hot": hot, "run": run, "seconds": took, "files": n, "largest_mb": largest}), flush=True)


if __name__ == "__main__":
    main()
