"""Two more types of record for the same layers and answers: green trips, and the `events` table as records of its own.

Both land as monthly files with a drift, and a second batch sends some records again with the amount negated.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, TimestampNTZType, TimestampType

from faremill import operators as ops
from faremill import plans
from faremill.contracts import (
    DERIVED,
    FILLED,
    GREEN_TRIPS,
    REQUIRED,
    TRIP_TYPE_CODES,
    ColumnSpec,
    PeriodRange,
    Roles,
    TableContract,
    TripKind,
)
from faremill.sinks.ingest import BATCH
from faremill.sources.landing import LandingZone
from workload.trips import INGESTED, LINEITEM, ORDERS, RESENT, TRIP_COLUMNS, landed_as, scratch, staged_once

# Column -> expression, in text that reads the same in Spark SQL and DuckDB.
_PICKUP = "o_orderdate + INTERVAL '1' HOUR * (l_suppkey % 24)"
_DROPOFF = (
    f"CASE WHEN l_shipdate < o_orderdate AND l_linenumber = 2 THEN {_PICKUP} - INTERVAL '1' HOUR "
    f"ELSE {_PICKUP} + INTERVAL '1' MINUTE * CAST(l_quantity AS INT) END"
)
GREEN_COLUMNS = {
    **{
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}.get(name, name): text
        for name, text in TRIP_COLUMNS.items()
        if name != "airport_fee"
    },
    "lpep_pickup_datetime": _PICKUP,
    "lpep_dropoff_datetime": _DROPOFF,
    "total_amount": "CASE WHEN l_orderkey % 8 = 4 THEN -l_extendedprice ELSE l_extendedprice + CAST(l_linenumber AS DOUBLE) END",
    "trip_type": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 3 + 1 AS BIGINT) END",
}
GREEN_IDS = ("l_orderkey", "l_linenumber")
GREEN_MONTHS = (1, 2, 3, 4, 5)
GREEN_WINDOW = PeriodRange.of([1996], GREEN_MONTHS)
GREEN_ORDER = ("etl_ingestion_timestamp", *GREEN_IDS)

EVENT_KIND = TripKind(
    "events",
    TableContract(
        (
            ColumnSpec("event_id", LongType(), "Number of the event", REQUIRED),
            ColumnSpec("ts", TimestampNTZType(), "Time of the event", REQUIRED),
            ColumnSpec("user_id", LongType(), "User who caused the event", REQUIRED),
            ColumnSpec("event_type", StringType(), "What the user did", REQUIRED),
            ColumnSpec("items", LongType(), "Items that the event's properties name", FILLED),
            ColumnSpec("value", DoubleType(), "Value of the event", REQUIRED),
            ColumnSpec("source_file_path", StringType(), "Landed file the record was read from", DERIVED),
            ColumnSpec("etl_ingestion_timestamp", TimestampType(), "Instant at which bronze took the record in", DERIVED),
            ColumnSpec("year", IntegerType(), "Calendar year of the event", DERIVED),
            ColumnSpec("month", IntegerType(), "Calendar month of the event", DERIVED),
            ColumnSpec("pickup_hour", IntegerType(), "Hour of day of the event", DERIVED),
        )
    ),
    Roles("ts", None, "items", "value"),
    ("user_id", "event_type", "ts"),
    ("event_id", "ts", "user_id", "event_type", "items", "value", "year", "month"),
)
EVENT_COLUMNS = {
    "event_id": "event_id",
    "ts": "ts",
    "user_id": "user_id",
    "event_type": "event_type",
    "items": "CAST(NULLIF(regexp_extract(props, '([0-9]+)', 1), '') AS BIGINT)",
    "value": "value",
}
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
EVENTS_RESENT = "event_id % 10 = 0"
EVENT_WINDOW = PeriodRange.of([2024], [1])
EVENT_ORDER = ("etl_ingestion_timestamp", "event_id")


def _twice(df: DataFrame, again: str) -> DataFrame:
    """Every row with the batch that sends it, some rows in both."""
    return df.selectExpr("*", f"explode(CASE WHEN {again} THEN array(1, 2) ELSE array(1) END) AS batch")


def _sent(copies: DataFrame, columns: dict[str, str], amount: str, ids: tuple[str, ...] = ()) -> DataFrame:
    """The rows as records; the second batch has the amount negated."""
    sent = {**columns, amount: f"CASE WHEN batch = 2 THEN -({columns[amount]}) ELSE {columns[amount]} END"}
    return copies.selectExpr("batch", *[f"{text} AS {name}" for name, text in sent.items()], *ids)


def green_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its order's date, some of them sent twice. The join sorts no lines, at any size: it holds a partition's orders."""
    lines = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").hint("shuffle_hash")
    return _twice(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey"), RESENT)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, some of them sent twice."""
    return _sent(_twice(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"), EVENTS_RESENT), EVENT_COLUMNS, "value")


def _land_green(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Months 2 to 5 land as they are, month 1 with the trip type as a fraction's type; what isn't of the window lands in month 1."""
    ours = GREEN_WINDOW.contains("lpep_pickup_datetime")
    month = F.when(ours, F.month("lpep_pickup_datetime")).otherwise(F.lit(1))
    staged = _sent(staged_once(green_lines(spark, sf_dir), f"{root}/staged"), GREEN_COLUMNS, "total_amount", GREEN_IDS)
    for n in GREEN_MONTHS:
        part = staged.where((F.col("batch") == 1) & (month == n)).drop("batch")
        part = part.withColumn("trip_type", F.col("trip_type").cast("double")) if n == 1 else part
        landed_as(part, f"{root}/batch-1/green/green_tripdata_1996-0{n}.parquet")
    landed_as(staged.where("batch = 2").drop("batch"), f"{root}/batch-2/green/green_tripdata_1996-05.parquet")


def _land_events(spark: SparkSession, sf_dir: str, root: str) -> None:
    """One month in each batch; the second has the items as a narrower type. Both are made of the table itself, with no shuffle or sort."""
    sent = event_records(spark, sf_dir)
    path = f"{root}/batch-{{}}/events/events_tripdata_2024-01.parquet".format
    landed_as(sent.where("batch = 1").drop("batch"), path(1))
    landed_as(sent.where("batch = 2").drop("batch").withColumn("items", F.col("items").cast("int")), path(2))


# Kind -> how it lands, years, months, window, order of survivors.
LANDINGS = {
    "green": (GREEN_TRIPS, _land_green, [1996], GREEN_MONTHS, GREEN_WINDOW, GREEN_ORDER),
    "events": (EVENT_KIND, _land_events, [2024], (1,), EVENT_WINDOW, EVENT_ORDER),
}
_lakes: dict[tuple[str, str, str], plans.LakehouseConfig] = {}
_lock = threading.Lock()


def lake_of(spark: SparkSession, sf_dir: str, name: str) -> plans.LakehouseConfig:
    """The three tables of a kind, built by the jobs every kind shares; once per session and data."""
    memo = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if memo not in _lakes:
            kind, land, years, months, window, order = LANDINGS[name]
            root, schema = scratch(spark), f"faremill_{name}_{uuid.uuid4().hex}"
            land(spark, sf_dir, root)
            zone = LandingZone(f"{root}/batch-1", [name], years, months)
            cfg = plans.LakehouseConfig.of_kind(
                kind, zone, schema=schema, schema_location=f"{root}/{schema}", order=order, window=window
            )
            plans.build_bronze(spark, cfg, F.lit(INGESTED[1]).cast("timestamp"))
            second = replace(cfg, zone=replace(cfg.zone, root=f"{root}/batch-2"))
            plans.build_bronze(spark, second, F.lit(INGESTED[2]).cast("timestamp"), mode="append")
            plans.build_silver(spark, cfg)
            plans.build_gold(spark, cfg)
            _lakes[memo] = cfg
        return _lakes[memo]


def drop_kinds(spark: SparkSession) -> None:
    """Drops the session's schemas of both kinds with their tables."""
    with _lock:
        for memo in [m for m in _lakes if m[0] == spark.sparkContext.applicationId]:
            spark.sql(f"DROP SCHEMA {_lakes.pop(memo).schema} CASCADE")


def silver_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    cfg = lake_of(spark, sf_dir, name)
    return spark.table(cfg.table(cfg.silver_name))


def gold_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    cfg = lake_of(spark, sf_dir, name)
    return spark.table(cfg.table(cfg.gold_name))


def bronze_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    cfg = lake_of(spark, sf_dir, name)
    return spark.table(cfg.table(cfg.bronze_name)).drop(BATCH)


def green_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = GREEN_TRIPS.roles
    keeps = {"time_travel": ops.in_time_order(roles.pickup, roles.dropoff), "out_of_window": GREEN_WINDOW.contains(roles.pickup)}
    notes = {"negative_total": F.col(roles.amount) < 0, "unknown_type": F.col("trip_type").isNull()}
    return ops.cleaning_waterfall(bronze_of(spark, sf_dir, "green"), keeps, notes, GREEN_TRIPS.key)


KIND_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "green_silver": lambda spark, sf_dir: silver_of(spark, sf_dir, "green").select(*GREEN_COLUMNS, "year", "month"),
    "green_gold": lambda spark, sf_dir: gold_of(spark, sf_dir, "green"),
    "green_waterfall": green_waterfall,
    "green_revenue_by_month": lambda spark, sf_dir: plans.revenue_by_month(gold_of(spark, sf_dir, "green"), GREEN_TRIPS.roles),
    "green_passengers_by_hour": lambda spark, sf_dir: plans.avg_passengers_by_hour(
        gold_of(spark, sf_dir, "green"), 1996, 5, roles=GREEN_TRIPS.roles
    ),
    "green_type_distribution": lambda spark, sf_dir: ops.code_distribution(silver_of(spark, sf_dir, "green"), TRIP_TYPE_CODES),
    "events_gold": lambda spark, sf_dir: gold_of(spark, sf_dir, "events"),
    "events_repeats": lambda spark, sf_dir: ops.duplicate_count(bronze_of(spark, sf_dir, "events"), EVENT_KIND.key),
    "events_value_by_month": lambda spark, sf_dir: plans.revenue_by_month(gold_of(spark, sf_dir, "events"), EVENT_KIND.roles),
    "events_ticket_by_month": lambda spark, sf_dir: plans.ticket_by_month(gold_of(spark, sf_dir, "events"), EVENT_KIND.roles),
    "events_items_by_hour": lambda spark, sf_dir: plans.avg_passengers_by_hour(
        gold_of(spark, sf_dir, "events"), 2024, 1, roles=EVENT_KIND.roles
    ),
}
