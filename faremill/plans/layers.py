"""Bronze, silver and gold: each layer as a plan, and as a job from table to table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faremill.contracts import (
    BRONZE_COMMENT,
    DEDUP_KEY,
    GOLD_COLUMNS,
    GOLD_COMMENT,
    SILVER_COMMENT,
    TRIP_CONTRACT,
    YELLOW_ROLES,
    CodeMap,
    PeriodRange,
    Roles,
    TableContract,
    TripKind,
)
from faremill.operators.clean import INGESTED, derive_calendar, first_per_key, in_time_order
from faremill.operators.enrich import TRIP_CODES, decode_codes, project
from faremill.errors import NoLandedPeriodsError
from faremill.sinks.ingest import BATCH, batch_number, landed_files, new_periods, write_manifest
from faremill.sinks.tables import create_schema, write_table
from faremill.sources.landing import LandedPeriod, LandingZone, landed_schemas, scan_periods

PARTITIONS = ("year", "month")


def bronze(
    spark: SparkSession,
    zone: LandingZone,
    contract: TableContract = TRIP_CONTRACT,
    ingested_at: Column | None = None,
    unknown: str = "keep",
    schemas: Mapping[LandedPeriod, StructType] | None = None,
) -> DataFrame:
    """Every landed row under the contract, with source path and ingestion time."""
    landed = scan_periods(spark, zone, contract, unknown, schemas)
    return landed.withColumn(INGESTED, F.current_timestamp() if ingested_at is None else ingested_at)


def silver(
    bronze_df: DataFrame,
    window: PeriodRange,
    key: Sequence[str] = DEDUP_KEY,
    order: Sequence[str] | None = None,
    roles: Roles = YELLOW_ROLES,
) -> DataFrame:
    """Bronze without impossible times, rows outside the window and repeats; calendar added.

    The filters only use key columns, so it doesn't matter to the result that they run first;
    it keeps rows they would drop out of the sort and shuffle of the de-duplication. A type without
    a dropoff has no impossible times.
    """
    possible = window.contains(roles.pickup)
    if roles.dropoff is not None:
        possible = in_time_order(roles.pickup, roles.dropoff) & possible
    return derive_calendar(first_per_key(bronze_df.filter(possible), key, order), roles.pickup)


def gold(
    silver_df: DataFrame,
    columns: Sequence[str] = GOLD_COLUMNS,
    code_maps: Sequence[CodeMap] = TRIP_CODES,
    roles: Roles = YELLOW_ROLES,
) -> DataFrame:
    """The analytical columns of every silver row, with pickup hour and decoded codes."""
    hours = derive_calendar(project(silver_df, columns), roles.pickup, ["pickup_hour"])
    return decode_codes(hours, code_maps)


@dataclass(frozen=True)
class LakehouseConfig:
    """What a run reads and where it writes."""

    zone: LandingZone
    schema: str = "trips"
    bronze_name: str = "taxi_bronze"
    silver_name: str = "taxi_silver"
    gold_name: str = "taxi_gold"
    contract: TableContract = TRIP_CONTRACT
    code_maps: Sequence[CodeMap] = TRIP_CODES
    key: Sequence[str] = DEDUP_KEY
    order: Sequence[str] | None = None
    write_mode: str = "overwrite"
    provider: str | None = None
    schema_location: str | None = None
    window: PeriodRange | None = None
    # Silver and gold overwrite only the months in the window. A record's key fixes its month,
    # so repeats never straddle two of them, and a month can be rebuilt by itself.
    replace_partitions: bool = False
    # Columns that the contract doesn't know: kept, where the table has them, or dropped.
    unknown: str = "keep"
    # Gold's columns of silver, and the columns that play pickup, dropoff, passengers and amount.
    columns: Sequence[str] = GOLD_COLUMNS
    roles: Roles = YELLOW_ROLES

    @classmethod
    def of_kind(cls, kind: TripKind, zone: LandingZone, **rest) -> LakehouseConfig:
        """The configuration of one type of record: its tables are named after it, and only its periods of the zone are read."""
        named = {f"{layer}_name": f"{kind.name}_{layer}" for layer in ("bronze", "silver", "gold")}
        own = dict(contract=kind.contract, code_maps=kind.code_maps, key=kind.key, columns=kind.columns, roles=kind.roles)
        return cls(replace(zone, kinds=[kind.name]), **{**named, **own, **rest})

    @property
    def valid(self) -> PeriodRange:
        """The window of valid pickups: the configured one, or the landing zone's months."""
        return self.window or self.zone.window()

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"


def build_bronze(
    spark: SparkSession, cfg: LakehouseConfig, ingested_at: Column | None = None, mode: str | None = None
) -> int:
    """Landing zone to bronze table; the number of files taken in. The plan is scan, cast, write: no shuffle, no sort.

    Bronze is partitioned by batch. With `mode="append"` a later landing zone, such as resent records, joins the earlier ones, but for the files that an
    earlier batch has: the same zone appended again changes nothing, and a run that broke off is taken up by the next. A file that changed since
    is a new one; the repeats among its rows are for silver to drop. Otherwise the zone's files replace all batches.
    """
    create_schema(spark, cfg.schema, cfg.schema_location)
    table, append = cfg.table(cfg.bronze_name), (mode or cfg.write_mode) == "append"
    files = landed_files(spark, cfg.zone)
    if not files:
        raise NoLandedPeriodsError(f"none of {len(cfg.zone.expected())} expected periods landed under {cfg.zone.root}")
    periods, new = new_periods(spark, table, files) if append else (None, files)
    if not new:
        return 0
    batch, schemas = batch_number(new), landed_schemas(spark, cfg.zone, periods)
    write_manifest(spark, table, new, batch)
    write_table(
        bronze(spark, cfg.zone, cfg.contract, ingested_at, cfg.unknown, schemas).withColumn(BATCH, F.lit(batch)),
        table,
        cfg.contract,
        BRONZE_COMMENT,
        partition_by=(BATCH,),
        provider=cfg.provider,
        replace_partitions=append,
        one={BATCH: batch},
    )
    return len(new)


def build_silver(spark: SparkSession, cfg: LakehouseConfig) -> None:
    """Bronze table to silver table.

    Two shuffles: one by the de-duplication key, one that gathers each month's rows into
    files of the advisory size. Without the second, every task of the first would write a
    small file into every month.
    """
    write_table(
        silver(spark.table(cfg.table(cfg.bronze_name)).drop(BATCH), cfg.valid, cfg.key, cfg.order, cfg.roles),
        cfg.table(cfg.silver_name),
        cfg.contract,
        SILVER_COMMENT,
        mode=cfg.write_mode,
        partition_by=PARTITIONS,
        provider=cfg.provider,
        rebalance=True,
        replace_partitions=cfg.replace_partitions,
        emptied=cfg.valid.covers(*PARTITIONS),
    )


def build_gold(spark: SparkSession, cfg: LakehouseConfig) -> None:
    """Silver table to gold table, row by row: the files keep silver's months, so no shuffle."""
    source = spark.table(cfg.table(cfg.silver_name))
    if cfg.replace_partitions:
        source = source.filter(cfg.valid.covers("year", "month"))
    write_table(
        gold(source, cfg.columns, cfg.code_maps, cfg.roles),
        cfg.table(cfg.gold_name),
        cfg.contract,
        GOLD_COMMENT,
        mode=cfg.write_mode,
        partition_by=PARTITIONS,
        provider=cfg.provider,
        replace_partitions=cfg.replace_partitions,
        emptied=cfg.valid.covers(*PARTITIONS),
    )


def build_lakehouse(spark: SparkSession, cfg: LakehouseConfig, ingested_at: Column | None = None) -> None:
    """All three layers. They meet in tables only, so each can also be rerun alone."""
    build_bronze(spark, cfg, ingested_at)
    build_silver(spark, cfg)
    build_gold(spark, cfg)
