"""Trip records made of `lineitem` and `orders`, and the landing zone written from them.

Every line of `lineitem` is a trip; some lines are sent a second time, in a later batch and
with the amount negated, so that keeping the wrong copy changes every revenue figure.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.contracts import PeriodRange
from faremill.sources.landing import LandingZone

# Column -> expression, in text that reads the same in Spark SQL and DuckDB.
TRIP_COLUMNS = {
    "VendorID": "CAST(CASE WHEN l_suppkey % 4 = 0 THEN 6 ELSE l_suppkey % 4 END AS BIGINT)",
    "tpep_pickup_datetime": "o_orderdate + INTERVAL '1' HOUR * (l_partkey % 24)",
    "tpep_dropoff_datetime": (
        "CASE WHEN l_shipdate < o_orderdate AND l_linenumber = 1 "
        "THEN o_orderdate + INTERVAL '1' HOUR * (l_partkey % 24) - INTERVAL '1' HOUR "
        "ELSE o_orderdate + INTERVAL '1' HOUR * (l_partkey % 24) + INTERVAL '1' MINUTE * CAST(l_quantity AS INT) END"
    ),
    "passenger_count": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber - 1 AS BIGINT) END",
    "trip_distance": "l_discount * 100",
    "RatecodeID": (
        "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 8 = 0 THEN CAST(99 AS BIGINT) "
        "ELSE CAST(l_partkey % 8 AS BIGINT) END"
    ),
    "store_and_fwd_flag": "CASE WHEN l_linenumber = 7 AND l_partkey % 9 <> 0 THEN NULL WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END",
    "PULocationID": "CAST(l_orderkey % 265 AS BIGINT)",
    "DOLocationID": "CAST(l_suppkey % 265 AS BIGINT)",
    "payment_type": "CAST(l_orderkey % 8 AS BIGINT)",
    "fare_amount": "l_extendedprice",
    "extra": "l_tax * 10",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "l_discount * l_quantity",
    "tolls_amount": "l_tax * l_quantity",
    "improvement_surcharge": "CAST(1.0 AS DOUBLE)",
    "total_amount": "CASE WHEN l_orderkey % 8 = 4 AND l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END",
    "congestion_surcharge": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(2.5 AS DOUBLE) END",
    "airport_fee": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(1.25 AS DOUBLE) END",
}
# Which lines are sent again.
RESENT = "l_linenumber = 2 AND l_partkey % 10 = 0"
RECORD_ID = ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
ORDER = ("etl_ingestion_timestamp", *RECORD_ID, "l_linenumber")

# Declared, so that a read doesn't spend a job on the footers.
LINEITEM = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ"
)
ORDERS = "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ"

INGESTED = {1: "2024-01-01 00:00:00", 2: "2024-01-02 00:00:00"}

YEAR, MONTHS = 1996, (1, 2, 3, 4, 5)
WINDOW = PeriodRange.of([YEAR], MONTHS)
ANSWER_MONTH = 5


def sent_lines(spark: SparkSession, sf_dir: str, within: PeriodRange | None = None, unsorted: bool = False) -> DataFrame:
    """Every line with its order's date and the batch that sends it, from one join; a resent line is doubled by an explode.

    `within` adds a bound on the order date that a pickup in that range implies (a pickup is
    0 to 23 hours after it). Unlike the pickup, the order date is a stored column, so the
    bound reaches the scan. It doesn't replace the filter on the pickup.

    `unsorted` has the join hold a partition's orders and pass its lines by them, at any size. What Spark takes beyond its broadcast
    threshold sorts all lines, and spills them where the partitions are few.
    """
    lines = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
    if within is not None:
        lo, hi = within.bounds()
        orders = orders.filter((F.col("o_orderdate") > lo - F.expr("INTERVAL '1' DAY")) & (F.col("o_orderdate") < hi))
    if unsorted:
        orders = orders.hint("shuffle_hash")
    dated = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return dated.selectExpr("*", f"explode(CASE WHEN {RESENT} THEN array(1, 2) ELSE array(1) END) AS batch")


def as_trips(lines: DataFrame) -> DataFrame:
    """The sent lines as trip records."""
    amount = TRIP_COLUMNS["total_amount"]
    columns = {**TRIP_COLUMNS, "total_amount": f"CASE WHEN batch = 2 THEN -({amount}) ELSE {amount} END"}
    return lines.selectExpr(
        *[f"{text} AS {name}" for name, text in columns.items()],
        "CASE batch WHEN 2 THEN 'batch-2' ELSE 'batch-1' END AS source_file_path",
        f"CASE batch WHEN 2 THEN TIMESTAMP_NTZ '{INGESTED[2]}' ELSE TIMESTAMP_NTZ '{INGESTED[1]}' END "
        "AS etl_ingestion_timestamp",
        *RECORD_ID,
        "l_linenumber",
    )


def trips(spark: SparkSession, sf_dir: str, within: PeriodRange | None = None) -> DataFrame:
    """All trips, both batches."""
    return as_trips(sent_lines(spark, sf_dir, within))


# Landing month of a trip: its own in the window's months, folded onto them otherwise, since a
# month's file also holds records whose clock is wrong.
LANDING_MONTH = "CAST((month(tpep_pickup_datetime) - 1) % 5 + 1 AS INT)"


def _drift_01(df: DataFrame) -> DataFrame:
    return df.withColumn("passenger_count", F.col("passenger_count").cast("double"))


def _drift_02(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in ("VendorID", "PULocationID")})


def _drift_03(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("airport_fee", "Airport_fee")


def _drift_04(df: DataFrame) -> DataFrame:
    return df.withColumn("cbd_fee", F.col("trip_distance") / 4)


def _drift_05(df: DataFrame) -> DataFrame:
    return df.drop("congestion_surcharge")


DRIFTS: dict[int, Callable[[DataFrame], DataFrame]] = {
    1: _drift_01,
    2: _drift_02,
    3: _drift_03,
    4: _drift_04,
    5: _drift_05,
}

KIND = "yellow"
_folders: dict[tuple[str, str], str] = {}

# Passengers as a month with a faulty export has them: no number, more than any integer, a fraction.
FAULTY_PASSENGERS = (
    "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 AND l_partkey % 3 = 0 THEN CAST('NaN' AS DOUBLE) "
    "WHEN l_linenumber = 6 AND l_partkey % 3 = 1 THEN CAST('-Infinity' AS DOUBLE) WHEN l_linenumber = 6 THEN CAST(1e30 AS DOUBLE) "
    "WHEN l_linenumber = 5 THEN CAST(3.5 AS DOUBLE) ELSE CAST(l_linenumber - 1 AS DOUBLE) END"
)
_lock = threading.Lock()


def scratch(spark: SparkSession) -> str:
    """A new folder name below the shared folder the session names in `spark.checkpoint.dir`."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
        import tempfile

        shared = tempfile.mkdtemp(prefix="faremill-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/faremill-{uuid.uuid4().hex}"


def landing_zone(root: str) -> LandingZone:
    """Batch 1: five months, each with a drift of its own. A sixth month is expected and absent."""
    return LandingZone(f"{root}/batch-1", [KIND], [YEAR], [*MONTHS, 6])


def resent_zone(root: str) -> LandingZone:
    """Batch 2: the resent records, all in the file of the last month, without drift."""
    return LandingZone(f"{root}/batch-2", [KIND], [YEAR], [5])


def landed_as(df: DataFrame, path: str, mode: str = "error") -> None:
    """The rows as a landed period's files."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def staged_once(lines: DataFrame, path: str) -> DataFrame:
    """The rows written to a path and read back, so that what is landed from them in several writes joins and shuffles once.

    They are stored before the records' columns are made of them, which are twice as many, and in the order they come in: a write that parts them by
    batch and month would sort them first, and spill. Each of the later writes filters them itself.
    """
    landed_as(lines, path)
    return lines.sparkSession.read.schema(lines.schema).parquet(path)


def _batches(spark: SparkSession, sf_dir: str, root: str) -> tuple[DataFrame, DataFrame]:
    """The landed columns of the first batch's trips and of the resent ones, from one join."""
    staged = staged_once(sent_lines(spark, sf_dir, unsorted=True), f"{root}/staged")
    first, again = (as_trips(staged.where(F.col("batch") == n)) for n in (1, 2))
    return first.drop("etl_ingestion_timestamp", "source_file_path"), again.drop("etl_ingestion_timestamp", "source_file_path")


def land(spark: SparkSession, sf_dir: str) -> str:
    """Write all trips as a drifting landing zone and return its root; once per session and data."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if memo not in _folders:
            root = scratch(spark)
            first, again = _batches(spark, sf_dir, root)
            for month, drift in DRIFTS.items():
                part = first.where(F.expr(LANDING_MONTH) == month)
                landed_as(drift(part), f"{root}/batch-1/{KIND}/{KIND}_tripdata_{YEAR}-{month:02d}.parquet")
            landed_as(again, f"{root}/batch-2/{KIND}/{KIND}_tripdata_{YEAR}-05.parquet")
            _folders[memo] = root
        return _folders[memo]


def faulty_zone(root: str) -> LandingZone:
    """Three months: passengers that no integer can hold, a folder of two footers, and one without a drift."""
    return LandingZone(f"{root}/faulty", [KIND], [YEAR], [1, 2, 3])


def land_faulty(spark: SparkSession, sf_dir: str) -> str:
    """Write the first batch's trips as a zone whose values the contract can't all keep: lines 1 to 3 land in month 3, later ones in 1, the resent in month 2."""
    memo = (spark.sparkContext.applicationId, f"{sf_dir}#faulty")
    with _lock:
        if memo not in _folders:
            root = scratch(spark)
            first, again = _batches(spark, sf_dir, root)
            path = f"{root}/faulty/{KIND}/{KIND}_tripdata_{YEAR}-0{{}}.parquet".format
            late = first.where("l_linenumber > 3")
            landed_as(late.withColumn("passenger_count", F.expr(FAULTY_PASSENGERS)), path(1))
            rates = again.withColumn("RatecodeID", F.col("RatecodeID") + F.lit(0.25))
            landed_as(rates.where("l_partkey % 20 = 0").drop("congestion_surcharge"), path(2))
            landed_as(rates.where("l_partkey % 20 <> 0"), path(2), mode="append")
            landed_as(first.where("l_linenumber <= 3"), path(3))
            _folders[memo] = root
        return _folders[memo]
