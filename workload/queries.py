"""Registered queries by name. Each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill import operators as ops
from faremill import plans
from faremill.contracts import (
    DEDUP_KEY,
    PAYMENT_CODES,
    RATECODES,
    SECONDARY_FIELDS,
    TRIP_CONTRACT,
    VENDOR_CODES,
    CodeMap,
    PeriodRange,
)
from faremill.functions import decode, money_label, month_label
from faremill.functions.money import exact_avg, exact_sum
from faremill.operators.clean import PICKUP
from faremill.sinks import column_dictionary, read_table
from faremill.sinks.ingest import committed_files
from faremill.sources import (
    cast_losses,
    conform,
    landed_schemas,
    period_coverage,
    read_landed,
    scan_declared,
    scan_periods,
    schema_drift,
)
from workload.kinds import KIND_QUERIES
from workload.trips import (
    ANSWER_MONTH,
    INGESTED,
    ORDER,
    RECORD_ID,
    TRIP_COLUMNS,
    WINDOW,
    YEAR,
    faulty_zone,
    land,
    land_faulty,
    landing_zone,
    resent_zone,
    scratch,
    trips,
)

Query = Callable[[SparkSession, str], DataFrame]

TRIP_ID = ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_linenumber", "source_file_path")
CONFLICT_COLUMNS = ("VendorID", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.silver(trips(spark, sf_dir, within=WINDOW), WINDOW, order=ORDER)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.gold(silver(spark, sf_dir))


def over(layer: Query, query: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """The query that applies an operator to a layer."""
    return lambda spark, sf_dir: query(layer(spark, sf_dir), *args, **kwargs)


# --- cleaning and projections ---


def duplicate_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    show = ["total_amount", "source_file_path", "l_orderkey"]
    return ops.duplicate_examples(trips(spark, sf_dir), show, n=5, order=ORDER)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = trips(spark, sf_dir).select(*TRIP_ID, *DEDUP_KEY, "total_amount")
    return ops.preview(shown, by=[*RECORD_ID, "source_file_path"], n=10)


def filter_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).filter(ops.in_time_order())


def filter_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir, within=WINDOW).filter(WINDOW.contains(PICKUP))


def derive_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ["year", "month", "pickup_hour"]
    return ops.derive_calendar(trips(spark, sf_dir), parts=parts).select(*TRIP_ID, PICKUP, *parts)


def cleaning_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    keeps = {"time_travel": ops.in_time_order(), "out_of_window": WINDOW.contains(PICKUP)}
    notes = {
        "systemic_nulls": reduce(and_, [F.col(c).isNull() for c in SECONDARY_FIELDS]),
        "negative_total": F.col("total_amount") < 0,
        "zero_passengers": F.col("passenger_count") == 0,
        "zero_distance": F.col("trip_distance") == 0,
    }
    return ops.cleaning_waterfall(trips(spark, sf_dir), keeps, notes)


# --- code decoding and labels ---


def decoded(codes: CodeMap) -> Query:
    return lambda spark, sf_dir: trips(spark, sf_dir).select(
        *TRIP_ID, codes.code_col, decode(codes).alias(codes.desc_col)
    )


def money_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = ops.derive_calendar(trips(spark, sf_dir))
    monthly = calendar.groupBy("year", "month").agg(
        exact_sum("total_amount").alias("total"), exact_avg("total_amount").alias("ticket")
    )
    return monthly.select(
        "year",
        "month",
        money_label(F.col("total") / 1_000_000, 1, "M").alias("total_label"),
        money_label(F.col("ticket"), 2).alias("ticket_label"),
    )


def month_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = ops.derive_calendar(trips(spark, sf_dir))
    by_month = calendar.groupBy("month").agg(F.count("*").alias("trips"))
    return by_month.select("month", month_label("month").alias("mes"), "trips")


# --- profiles ---


def anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "zero_passengers": F.col("passenger_count") == 0,
        "zero_distance": F.col("trip_distance") == 0,
        "null_passengers": F.col("passenger_count").isNull(),
        "negative_total": F.col("total_amount") < 0,
        "time_travel": ops.time_travel(),
        "out_of_window": WINDOW.excludes(PICKUP),
    }
    return ops.anomaly_counts(trips(spark, sf_dir), rules)


def bronze_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of all bronze profiles in one scan."""
    rules = {
        "all_null": reduce(and_, [F.col(c).isNull() for c in SECONDARY_FIELDS]),
        "zero_passengers": F.col("passenger_count") == 0,
        "zero_distance": F.col("trip_distance") == 0,
        "negative_total": F.col("total_amount") < 0,
        "time_travel": ops.time_travel(),
        "out_of_window": WINDOW.excludes(PICKUP),
    }
    return ops.grouped_profile(trips(spark, sf_dir), rules)


def silver_anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "null_passengers": F.col("passenger_count").isNull(),
        "zero_passengers": F.col("passenger_count") == 0,
        "unpaid_total": F.col("total_amount") <= 0,
    }
    return ops.anomaly_counts(silver(spark, sf_dir), rules, digits=2)


def null_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendor = {"VendorID": F.col("VendorID")}
    missing = F.col("passenger_count").isNull()
    return ops.group_share(trips(spark, sf_dir), vendor, missing, of="total", digits=4).orderBy("VendorID")


def time_travel_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendor = {"VendorID": F.col("VendorID")}
    shares = ops.group_share(trips(spark, sf_dir), vendor, ops.time_travel(), of="subset", digits=2)
    return shares.orderBy(F.desc("trips"), "VendorID")


def negative_total_by_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    payment = {"payment_type_desc": decode(PAYMENT_CODES, numbered=True)}
    negative = F.col("total_amount") < 0
    shares = ops.group_share(trips(spark, sf_dir), payment, negative, of="subset", digits=2)
    return shares.orderBy(F.desc("trips"), "payment_type_desc")


def out_of_range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.daily_counts(trips(spark, sf_dir).filter(WINDOW.excludes(PICKUP)), PICKUP, n=10)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = [
        ops.table_size(trips(spark, sf_dir).select(*TRIP_COLUMNS), "landed"),
        ops.table_size(silver(spark, sf_dir).drop(*RECORD_ID, "l_linenumber"), "silver"),
        ops.table_size(gold(spark, sf_dir), "gold"),
    ]
    return reduce(DataFrame.unionByName, sizes)


# --- landing zone, drift and tables ---

# What the landed files hold beside the contract's columns.
EXTRA = (*RECORD_ID, "l_linenumber", "cbd_fee")


def file_name() -> Column:
    """Batch, kind and file of a source path."""
    return F.substring_index("source_file_path", "/", -3)


def scan_periods_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = landing_zone(land(spark, sf_dir))
    return scan_periods(spark, zone, TRIP_CONTRACT).withColumn("source_file_path", file_name())


def month_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of every landed month, each read by itself."""
    zone = landing_zone(land(spark, sf_dir))
    months = landed_schemas(spark, zone)
    return reduce(
        DataFrame.unionByName, [ops.table_size(spark.read.schema(s).parquet(*p.paths), p.key) for p, s in months.items()]
    )


def period_coverage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_coverage(spark, landing_zone(land(spark, sf_dir)))


def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).groupBy(file_name().alias("source_file")).agg(F.count("*").alias("trips"))


def schema_enforced_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed months under one declared schema, also the column that landed as `double`."""
    declared = TRIP_CONTRACT.struct(TRIP_COLUMNS)
    for record_id in ("l_orderkey", "l_partkey", "l_suppkey"):
        declared = declared.add(record_id, "long")
    return scan_declared(spark, landing_zone(land(spark, sf_dir)), declared)


def conflict_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns whose types differ between months, under the declared schema."""
    return schema_enforced_scan(spark, sf_dir).select(*CONFLICT_COLUMNS, "l_orderkey", "l_partkey", "l_suppkey")


def union_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed months as they are, folded by column name: types widen, absent columns are NULL."""
    zone = landing_zone(land(spark, sf_dir))
    frames = [df for _, df in read_landed(spark, landed_schemas(spark, zone))]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.select(*TRIP_COLUMNS, *EXTRA)


def contract_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(union_drift(spark, sf_dir), TRIP_CONTRACT)


def cast_losses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_losses(spark, faulty_zone(land_faulty(spark, sf_dir)), TRIP_CONTRACT)


def faulty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a zone with values that no integer can hold and a month of two footers."""
    rows = scan_periods(spark, faulty_zone(land_faulty(spark, sf_dir)), TRIP_CONTRACT)
    return rows.groupBy(F.substring_index("source_file_path", "/", -1).alias("landed_as")).agg(
        F.count("*").alias("row_count"),
        *[F.count(c).alias(f"n_{c}") for c in ("passenger_count", "congestion_surcharge", "RatecodeID")],
        *[F.sum(c).alias(f"sum_{c}") for c in ("passenger_count", "RatecodeID")],
    )


def schema_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_drift(spark, landing_zone(land(spark, sf_dir)), TRIP_CONTRACT)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches; the second came in a day after the first."""
    root = land(spark, sf_dir)
    zones = {1: landing_zone(root), 2: resent_zone(root)}
    batches = [
        plans.bronze(spark, zone, ingested_at=F.lit(INGESTED[n]).cast("timestamp_ntz")) for n, zone in zones.items()
    ]
    return batches[0].unionByName(batches[1], allowMissingColumns=True)


def bronze_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).withColumn("source_file_path", file_name())


def lakehouse(spark: SparkSession, sf_dir: str) -> plans.LakehouseConfig:
    """A new schema in the shared folder, with both batches in bronze: one written, one appended."""
    root = land(spark, sf_dir)
    name = f"faremill_{uuid.uuid4().hex}"
    cfg = plans.LakehouseConfig(
        landing_zone(root), schema=name, schema_location=f"{scratch(spark)}/{name}", order=ORDER, window=WINDOW
    )
    plans.build_bronze(spark, cfg, F.lit(INGESTED[1]).cast("timestamp_ntz"))
    again = replace(cfg, zone=resent_zone(root))
    plans.build_bronze(spark, again, F.lit(INGESTED[2]).cast("timestamp_ntz"), mode="append")
    return cfg


_lakes: dict[tuple[str, str], plans.LakehouseConfig] = {}
_lock = threading.Lock()


def shared_lakehouse(spark: SparkSession, sf_dir: str) -> plans.LakehouseConfig:
    """The lakehouse with all three layers, built once per session and data."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if memo not in _lakes:
            cfg = lakehouse(spark, sf_dir)
            plans.build_silver(spark, cfg)
            plans.build_gold(spark, cfg)
            _lakes[memo] = cfg
        return _lakes[memo]


def drop_lakehouses(spark: SparkSession) -> None:
    """Drops the session's shared lakehouses with their tables."""
    with _lock:
        for memo in [m for m in _lakes if m[0] == spark.sparkContext.applicationId]:
            spark.sql(f"DROP SCHEMA {_lakes.pop(memo).schema} CASCADE")


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = shared_lakehouse(spark, sf_dir)
    return read_table(spark, cfg.table(cfg.bronze_name)).drop("ingest_batch").withColumn("source_file_path", file_name())


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = shared_lakehouse(spark, sf_dir)
    return read_table(spark, cfg.table(cfg.gold_name))


def repeated_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after both batches were appended a second time: rows by file, and the files that the manifest has for them."""
    cfg = lakehouse(spark, sf_dir)
    for n, zone in ((1, cfg.zone), (2, resent_zone(land(spark, sf_dir)))):
        plans.build_bronze(spark, replace(cfg, zone=zone), F.lit(INGESTED[n]).cast("timestamp_ntz"), mode="append")
    table = cfg.table(cfg.bronze_name)
    rows = read_table(spark, table).groupBy(file_name().alias("source_file")).agg(F.count("*").alias("trips"), exact_sum("total_amount").alias("amount"))
    # A landed path is a folder of files here.
    folder = F.regexp_replace("path", "/[^/]*$", "")
    files = committed_files(spark, table).groupBy(F.substring_index(folder, "/", -3).alias("source_file")).agg((F.count("*") > 0).alias("in_manifest"))
    return rows.join(files, "source_file", "left")


def staged_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built whole, then built again for one of its months by itself, from the same bronze."""
    cfg = lakehouse(spark, sf_dir)
    plans.build_silver(spark, cfg)
    plans.build_silver(spark, replace(cfg, window=PeriodRange.of([YEAR], [3]), replace_partitions=True))
    return read_table(spark, cfg.table(cfg.silver_name)).drop("cbd_fee", "congestion_surcharge", "source_file_path", *RECORD_ID, "l_linenumber")


def column_dictionary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog says of each gold column, and how many values the table holds in it."""
    cfg = shared_lakehouse(spark, sf_dir)
    table = read_table(spark, cfg.table(cfg.gold_name))
    filled = table.agg(*[F.count(c).alias(c) for c in table.columns])
    filled = filled.unpivot([], table.columns, "column_name", "values_present")
    words = column_dictionary(spark, cfg.table(cfg.gold_name))
    return words.join(filled, "column_name").select("column_name", "type_name", "comment", "values_present")


QUERIES: dict[str, Query] = {
    # answers
    "revenue_by_month": over(gold, plans.revenue_by_month),
    "ticket_by_month": over(gold, plans.ticket_by_month),
    "period_means": over(gold, plans.period_means),
    "revenue_report": over(gold, plans.revenue_report),
    "revenue_report_sql": over(gold, plans.revenue_report_sql),
    "avg_passengers_by_hour": over(gold, plans.avg_passengers_by_hour, YEAR, ANSWER_MONTH),
    "hour_extremes": over(gold, plans.hour_extremes, YEAR, ANSWER_MONTH),
    "hours_wide": over(gold, plans.hours_wide, YEAR, ANSWER_MONTH),
    "daypart_profile": over(gold, plans.daypart_profile, YEAR, ANSWER_MONTH),
    # cleaning and layers
    "dedup_first": over(trips, ops.first_per_key, DEDUP_KEY, ORDER),
    "duplicate_count": over(trips, ops.duplicate_count),
    "duplicate_examples": duplicate_examples,
    "preview": preview,
    "filter_time_order": filter_time_order,
    "filter_window": filter_window,
    "derive_calendar": derive_calendar,
    "cleaning_waterfall": cleaning_waterfall,
    "silver_build": silver,
    "gold_projection": over(silver, ops.project),
    "gold_build": gold,
    # code decoding and labels
    "decode_vendor": decoded(VENDOR_CODES),
    "decode_ratecode": decoded(RATECODES),
    "decode_payment": decoded(PAYMENT_CODES),
    "money_labels": money_labels,
    "month_labels": month_labels,
    # bronze profiles
    "null_profile": over(trips, ops.null_profile),
    "null_by_vendor": null_by_vendor,
    "simultaneous_nulls": over(trips, ops.simultaneous_nulls),
    "anomaly_counts": anomaly_counts,
    "time_travel_profile": time_travel_profile,
    "negative_total_by_payment": negative_total_by_payment,
    "metric_extremes": over(trips, ops.metric_extremes),
    "out_of_range_profile": out_of_range_profile,
    "bronze_profile": bronze_profile,
    "row_counts": row_counts,
    # silver profiles
    "completeness": over(silver, ops.completeness),
    "silver_anomaly_counts": silver_anomaly_counts,
    "filter_interaction": over(silver, ops.filter_interaction),
    "null_code_origin": over(silver, ops.null_code_origin),
    "monthly_profile": over(silver, ops.monthly_profile),
    "monthly_chargebacks": over(silver, ops.monthly_chargebacks),
    "chargeback_impact": over(silver, ops.chargeback_impact),
    "chargeback_impact_one_pass": over(silver, ops.chargeback_impact_one_pass),
    "hourly_profile": over(silver, ops.hourly_profile, YEAR, ANSWER_MONTH),
    "avg_zero_impact": over(silver, ops.avg_zero_impact, YEAR, ANSWER_MONTH),
    "vendor_distribution": over(silver, ops.code_distribution, VENDOR_CODES),
    "ratecode_distribution": over(silver, ops.code_distribution, RATECODES),
    "payment_distribution": over(silver, ops.code_distribution, PAYMENT_CODES),
    # landing zone, drift and tables
    "scan_periods": scan_periods_query,
    "month_sizes": month_sizes,
    "period_coverage": period_coverage_query,
    "source_lineage": source_lineage,
    "schema_enforced_scan": schema_enforced_scan,
    "conflict_columns": conflict_columns,
    "union_drift": union_drift,
    "contract_cast": contract_cast,
    "schema_drift": schema_drift_query,
    "cast_losses": cast_losses_query,
    "faulty_scan": faulty_scan,
    "bronze_build": bronze_build,
    "sink_roundtrip": sink_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "column_dictionary": column_dictionary_query,
    "repeated_ingest": repeated_ingest,
    "staged_rebuild": staged_rebuild,
    # other types of record
    **KIND_QUERIES,
}
