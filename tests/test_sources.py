import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from faremill import TRIP_CONTRACT, MissingColumnError, NoLandedPeriodsError, SchemaDriftError, TableContract
from faremill.sources import (
    LandingZone,
    drift_table,
    landed_schemas,
    period_coverage,
    read_enforced,
    read_landed,
    scan_periods,
    schema_drift,
)
from faremill.sources import landing


@pytest.fixture
def zone(tmp_path):
    return LandingZone(str(tmp_path / "landing"), ["yellow"], ["2023"], ["01", "02", "03"])


@pytest.fixture
def land(zone, make_trips):
    """Write one month of a few trips, changed by `drift`, and leave the other months alone."""

    def write(month, drift=lambda df: df, n=2, one_file=False):
        rows = [{"tpep_pickup_datetime": datetime(2023, month, 2, i), "PULocationID": i} for i in range(n)]
        path = next(p.path for p in zone.expected() if p.month == month)
        drift(make_trips(rows).drop("source_file_path", "etl_ingestion_timestamp")).write.parquet(path)

    return write


def test_absent_months_are_skipped(spark, zone, land):
    land(1)
    land(3)
    assert [p.month for p in landed_schemas(spark, zone)] == [1, 3]
    assert scan_periods(spark, zone, TRIP_CONTRACT).count() == 4


def test_nothing_landed_is_an_error(spark, zone):
    with pytest.raises(NoLandedPeriodsError):
        scan_periods(spark, zone, TRIP_CONTRACT)
    assert [(r.month, r.landed, r.rows) for r in period_coverage(spark, zone).orderBy("month").collect()] == [
        (1, False, 0),
        (2, False, 0),
        (3, False, 0),
    ]


def test_coverage_counts_rows(spark, zone, land):
    land(1, n=3)
    land(2, lambda df: df.withColumn("passenger_count", F.col("passenger_count").cast("double")))
    got = [(r.month, r.landed, r.rows) for r in period_coverage(spark, zone).orderBy("month").collect()]
    assert got == [(1, True, 3), (2, True, 2), (3, False, 0)]


def test_an_empty_landed_month_is_landed(spark, zone, land):
    land(1)
    land(2, lambda df: df.limit(0))
    got = [(r.month, r.landed, r.rows) for r in period_coverage(spark, zone).orderBy("month").collect()]
    assert got == [(1, True, 2), (2, True, 0), (3, False, 0)]


def test_fractions_are_cut_and_types_meet_the_contract(spark, zone, land):
    land(1, lambda df: df.withColumn("passenger_count", F.lit(1.9)))
    land(2, lambda df: df.withColumn("passenger_count", F.lit(-1.9)).withColumn("VendorID", F.lit(2)))
    land(3, lambda df: df.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp")))
    df = scan_periods(spark, zone, TRIP_CONTRACT)
    for f in df.schema.fields:
        assert f.dataType == TRIP_CONTRACT.find(f.name).data_type
    assert {r[0] for r in df.select("passenger_count").collect()} == {1, -1}
    assert {r.tpep_pickup_datetime.month for r in df.collect()} == {1, 2, 3}


def test_name_case_missing_and_unknown_columns(spark, zone, land):
    land(1, lambda df: df.withColumn("Airport_fee", F.lit(1.0)))
    land(2, lambda df: df.withColumn("airport_fee", F.lit(2.0)).withColumn("cbd_fee", F.lit(7.0)))
    land(3, lambda df: df.drop("RatecodeID"))
    df = scan_periods(spark, zone, TRIP_CONTRACT)
    got = df.groupBy(F.month("tpep_pickup_datetime").alias("m")).agg(
        F.max("airport_fee"), F.max("cbd_fee"), F.max("RatecodeID")
    )
    assert {tuple(r) for r in got.collect()} == {(1, 1.0, None, 1), (2, 2.0, 7.0, 1), (3, None, None, None)}
    assert df.columns[:20] == [*[c.name for c in TRIP_CONTRACT.columns[:19]], "source_file_path"]
    assert "cbd_fee" not in scan_periods(spark, zone, TRIP_CONTRACT, unknown="drop").columns
    assert "cbd_congestion_fee" not in df.columns


def test_required_column_nowhere_is_a_named_error(spark, zone, land):
    land(1, lambda df: df.drop("total_amount"))
    with pytest.raises(MissingColumnError, match="total_amount"):
        scan_periods(spark, zone, TRIP_CONTRACT)
    land(2)
    assert scan_periods(spark, zone, TRIP_CONTRACT).filter("total_amount IS NULL").count() == 2


def test_text_in_a_number_column_is_a_named_error(spark, zone, land):
    land(1, lambda df: df.withColumn("passenger_count", F.lit("two")))
    with pytest.raises(SchemaDriftError, match="passenger_count"):
        scan_periods(spark, zone, TRIP_CONTRACT)


def test_lineage_is_the_landed_path(spark, zone, land):
    land(1)
    land(2)
    got = {r[0].split("/")[-1] for r in scan_periods(spark, zone, TRIP_CONTRACT).select("source_file_path").collect()}
    assert got == {"yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-02.parquet"}


def test_periods_of_one_schema_are_one_relation(spark, zone, land):
    land(1)
    land(3)
    ((periods, df),) = read_landed(spark, landed_schemas(spark, zone))
    assert [p.month for p in periods] == [1, 3] and df.count() == 4


@pytest.fixture(scope="module")
def many_periods(tmp_path_factory):
    """480 periods of three schemas below a root whose name has to be written in another way in a URI; some are folders of files."""
    root = tmp_path_factory.mktemp("la nd%20ü")
    zone = LandingZone(str(root), ["yellow", "green"], range(2000, 2020), range(1, 13))
    (root / "yellow").mkdir()
    (root / "green").mkdir()
    tables = [
        pa.table({"VendorID": pa.array([1, 2], pa.int64())}),
        pa.table({"VendorID": pa.array([1], pa.int32()), "extra": pa.array([1.0])}),
        pa.table({"VendorID": pa.array([3.0, float("nan"), 5.0])}),
    ]
    rows = {}
    for i, p in enumerate(zone.expected()):
        if i % 7 == 5:
            os.mkdir(p.path)
            for part in ("data one.parquet", "data%20two.parquet"):
                pq.write_table(tables[i % 3], f"{p.path}/{part}")
        else:
            pq.write_table(tables[i % 3], p.path)
        rows[p] = tables[i % 3].num_rows * (2 if i % 7 == 5 else 1)
    return zone, rows


def test_a_plan_has_one_relation_per_schema(spark, many_periods):
    zone, rows = many_periods
    contract = TableContract(tuple(c for c in TRIP_CONTRACT.columns if c.name in ("VendorID", "extra", "source_file_path")))
    df = scan_periods(spark, zone, contract)
    assert plan_of(df).count("FileScan parquet") == 3
    counts = {r["source_file_path"]: r["count"] for r in df.groupBy("source_file_path").count().collect()}
    assert counts == {p.path: n for p, n in rows.items()}
    assert {(r.kind, r.year, r.month, r.rows) for r in period_coverage(spark, zone).collect()} == {(p.kind, p.year, p.month, n) for p, n in rows.items()}


def test_relations_of_few_files_give_the_same_rows(spark, many_periods, monkeypatch):
    zone, rows = many_periods
    few = LandingZone(zone.root, ["green"], [2000, 2001], range(1, 13))
    monkeypatch.setattr(landing, "FILES_AT_ONCE", 3)
    assert {(r.year, r.month, r.rows) for r in period_coverage(spark, few).collect()} == {(p.year, p.month, rows[p]) for p in few.expected()}


@pytest.mark.parametrize("name", ["with space", "ünïcode%20x", "plain"])
@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}", "{}/"])
def test_coverage_doesnt_depend_on_the_text_of_the_root(spark, tmp_path, name, form):
    root = tmp_path / name
    spark.range(3).write.parquet(str(root / "yellow/yellow_tripdata_2023-01.parquet"))
    zone = LandingZone(form.format(root), ["yellow"], [2023], [1, 2])
    got = [(r.month, r.landed, r.rows) for r in period_coverage(spark, zone).orderBy("month").collect()]
    assert got == [(1, True, 3), (2, False, 0)]


def _folder(spark, root, *frames):
    """A landed folder whose files have names of their own."""
    folder = root / "yellow/yellow_tripdata_2023-01.parquet"
    folder.mkdir(parents=True)
    for i, frame in enumerate(frames):
        frame.toPandas().to_parquet(folder / f"data-{i}.parquet", index=False)
    return LandingZone(str(root), ["yellow"], [2023], [1])


def test_foreign_file_names_and_two_footers_in_a_folder(spark, tmp_path):
    zone = _folder(spark, tmp_path, spark.sql("SELECT 1L AS VendorID"), spark.sql("SELECT 2L AS VendorID, 7.0D AS airport_fee"))
    assert [(r.landed, r.rows) for r in period_coverage(spark, zone).collect()] == [(True, 2)]
    (schema,) = landed_schemas(spark, zone).values()
    assert schema.fieldNames() == ["VendorID", "airport_fee"]
    ((_, df),) = read_landed(spark, landed_schemas(spark, zone))
    assert sorted((r.VendorID, r.airport_fee) for r in df.collect()) == [(1, None), (2, 7.0)]


def test_types_that_disagree_within_a_period_are_a_named_error(spark, tmp_path):
    zone = _folder(spark, tmp_path, spark.sql("SELECT 1L AS VendorID"), spark.sql("SELECT 'x' AS VendorID"))
    with pytest.raises(SchemaDriftError, match="2023_01"):
        landed_schemas(spark, zone)


def test_drift_table_marks_types_and_absences(spark, zone, land):
    land(1)
    land(2, lambda df: df.withColumn("VendorID", F.lit(1)).drop("RatecodeID"))
    rows = {r.column_name: r for r in drift_table(spark, landed_schemas(spark, zone)).collect()}
    assert rows["VendorID"].asDict() == {
        "column_name": "VendorID", "2023_01": "bigint", "2023_02": "int", "n_types": 2, "drifts": True,
    }
    assert rows["RatecodeID"]["2023_02"] == "--- AUSENTE ---" and rows["RatecodeID"].drifts
    assert not rows["total_amount"].drifts


def test_drift_counts_the_values_it_touches(spark, zone, land):
    land(1, n=3)
    land(2, lambda df: df.withColumn("VendorID", F.when(F.col("PULocationID") > 0, F.lit(1))))
    rows = {r.column_name: r for r in schema_drift(spark, zone, TRIP_CONTRACT).collect()}
    assert (rows["VendorID"].values_present, rows["VendorID"].values_retyped) == (4, 1)
    # What lands everywhere with one type is not read.
    assert (rows["total_amount"].values_present, rows["total_amount"].values_retyped) == (None, None)


def test_enforced_read_widens_integers(spark, zone, land):
    land(1)
    land(2, lambda df: df.withColumn("VendorID", F.lit(1)).drop("RatecodeID"))
    df = read_enforced(spark, TRIP_CONTRACT.struct(), f"{zone.root}/yellow/*.parquet")
    assert df.dtypes[0] == ("VendorID", "bigint") and len(df.columns) == 19
    assert {(r.VendorID, r.RatecodeID) for r in df.collect()} == {(1, 1), (1, None)}


def test_enforced_read_of_double_as_long_fails_where_the_scan_works(spark, zone, land):
    land(1, lambda df: df.withColumn("passenger_count", F.lit(1.0)))
    # raised in a task, so it arrives as the gateway's error rather than a PySpark one
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH"):
        read_enforced(spark, TRIP_CONTRACT.struct(), f"{zone.root}/yellow/*.parquet").collect()
    assert scan_periods(spark, zone, TRIP_CONTRACT).count() == 2


def test_several_kinds_and_years(spark, tmp_path):
    zone = LandingZone(str(tmp_path), ["yellow", "green"], [2023, 2024], [1, 2])
    assert len(zone.expected()) == 8
    assert zone.expected()[0].path.endswith("/yellow/yellow_tripdata_2023-01.parquet")
    assert zone.window().end == datetime(2024, 3, 1)
