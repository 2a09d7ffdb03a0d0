"""Values that the contract's cast loses or cuts, counted by column and period."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faremill.contracts import TRIP_CONTRACT
from faremill.errors import SchemaDriftError
from faremill.sources import LandingZone, cast_losses, scan_periods
from tests.conftest import executed_nodes


@pytest.fixture
def zone(tmp_path, make_trips):
    def land(month, df):
        landed = df.drop("source_file_path", "etl_ingestion_timestamp")
        landed.coalesce(1).write.mode("append").parquet(f"{tmp_path}/yellow/yellow_tripdata_2023-{month:02d}.parquet")

    three = make_trips([{"total_amount": float(i)} for i in range(8)])
    odd = F.expr(
        "element_at(array(CAST('NaN' AS double), CAST('Infinity' AS double), CAST('-Infinity' AS double), 1e30D, -9.3e18D, 2.5D, -1.5D, CAST(NULL AS double)),"
        " CAST(total_amount AS int) + 1)"
    )
    land(1, three.withColumn("passenger_count", odd))
    land(2, three.withColumn("passenger_count", F.col("total_amount")).withColumn("RatecodeID", F.lit(1.25).cast("decimal(4,2)")))
    land(3, three)
    land(4, three.withColumn("passenger_count", odd).limit(0))
    return LandingZone(str(tmp_path), ["yellow"], [2023], [1, 2, 3, 4, 5])


def test_lost_and_cut_values_are_counted_by_period(spark, zone):
    got = {tuple(r) for r in cast_losses(spark, zone, TRIP_CONTRACT).collect()}
    assert got == {
        ("passenger_count", "yellow", "2023_01", "double", 7, 5, 2),
        ("passenger_count", "yellow", "2023_02", "double", 8, 0, 0),
        ("RatecodeID", "yellow", "2023_02", "decimal(4,2)", 8, 0, 8),
    }


def test_the_scan_loses_what_the_report_says(spark, zone):
    rows = scan_periods(spark, zone, TRIP_CONTRACT).where(F.col("source_file_path").endswith("2023-01.parquet"))
    assert rows.where("passenger_count IS NOT NULL").count() == 7 - 5


def test_only_columns_at_risk_are_read(spark, zone):
    report = cast_losses(spark, zone, TRIP_CONTRACT)
    report.collect()
    read = [node.schema().simpleString() for name, node in executed_nodes(report) if name == "FileSourceScanExec"]
    assert sorted(read) == ["struct<passenger_count:double,RatecodeID:decimal(4,2)>", "struct<passenger_count:double>"]


def test_nothing_at_risk_gives_no_rows(spark, zone):
    calm = LandingZone(zone.root, ["yellow"], [2023], [3])
    report = cast_losses(spark, calm, TRIP_CONTRACT)
    assert report.count() == 0 and report.columns[0] == "column_name"


def test_a_folder_whose_files_disagree_is_named(spark, zone, make_trips):
    again = make_trips([{}]).drop("source_file_path", "etl_ingestion_timestamp").withColumn("passenger_count", F.lit("two"))
    again.write.mode("append").parquet(f"{zone.root}/yellow/yellow_tripdata_2023-03.parquet")
    with pytest.raises(SchemaDriftError):
        cast_losses(spark, zone, TRIP_CONTRACT)
