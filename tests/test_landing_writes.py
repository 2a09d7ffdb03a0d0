"""Landing zones and bronze are written without sorts, and what is staged for them is no wider than the tables."""

import pytest
from conftest import plan_of
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from faremill import TableContract
from faremill.plans import LakehouseConfig, build_bronze
from faremill.sinks import create_schema, read_table, write_table
from faremill.sinks.staging import partition_names
from workload import kinds, trips

RAW = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"}


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """120 orders over a year of days, 7 lines each, every tenth second line resent; and 40 events."""
    monkeypatch.setattr(trips, "_folders", {})
    monkeypatch.setattr(kinds, "_lakes", {})
    day = F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00' + make_interval(0, 0, 0, CAST(o_orderkey * 3 AS INT))")
    orders = spark.range(120).select(F.col("id").alias("o_orderkey")).withColumn("o_orderdate", day)
    lines = spark.range(840).selectExpr(
        "id div 7 AS l_orderkey", "id div 7 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
        "'N' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP_NTZ '1997-06-01 00:00:00' AS l_shipdate",
    )
    events = spark.range(40).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-05 00:00:00' AS ts", "id % 7 AS user_id", "'click' AS event_type", "CAST(id AS DOUBLE) AS value", "'{\"n\": 3}' AS props"
    )
    for name, df in (("orders", orders), ("lineitem", lines), ("events", events)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def parted(monkeypatch):
    """The frames whose writes are partitioned, and so sorted by partition."""
    seen, plain = [], DataFrameWriter.partitionBy

    def partition_by(writer, *cols):
        seen.append(writer._df)
        return plain(writer, *cols)

    monkeypatch.setattr(DataFrameWriter, "partitionBy", partition_by)
    return seen


def staged_columns(spark, root):
    return set(spark.read.parquet(f"{root}/staged").columns)


def test_the_trips_land_without_a_sort_from_rows_as_wide_as_the_tables(spark, tables, parted):
    root = trips.land(spark, tables)
    assert parted == []
    assert staged_columns(spark, root) == RAW | {"o_orderdate", "batch"}
    landed = [spark.read.parquet(p.path).count() for p in trips.landing_zone(root).expected()[:5]]
    assert sum(landed) == 840 and min(landed) > 0
    assert spark.read.parquet(trips.resent_zone(root).expected()[0].path).count() == 12


def test_the_faulty_zone_lands_without_a_sort(spark, tables, parted):
    root = trips.land_faulty(spark, tables)
    assert parted == []
    assert staged_columns(spark, root) == RAW | {"o_orderdate", "batch"}
    assert [spark.read.parquet(p.path).count() for p in trips.faulty_zone(root).expected()] == [480, 12, 360]


def test_green_trips_and_events_land_without_a_sort(spark, tables, parted, tmp_path):
    kinds._land_green(spark, tables, f"{tmp_path}/green")
    kinds._land_events(spark, tables, f"{tmp_path}/events")
    assert parted == []
    assert staged_columns(spark, f"{tmp_path}/green") == RAW | {"o_orderdate", "batch"}
    counts = [spark.read.parquet(f"{tmp_path}/green/batch-1/green/green_tripdata_1996-0{n}.parquet").count() for n in range(1, 6)]
    assert sum(counts) == 840 and min(counts) > 0
    assert spark.read.parquet(f"{tmp_path}/events/batch-2/events/events_tripdata_2024-01.parquet").count() == 4


@pytest.mark.parametrize("land", [trips.land, trips.land_faulty, lambda spark, tables: kinds._land_green(spark, tables, f"{tables}/green")], ids=["trips", "faulty", "green"])
def test_tables_too_big_to_broadcast_land_without_a_sort(spark, tables, monkeypatch, land):
    """Orders of a key twice, and of none, as the tables may have them."""
    spark.sql("SELECT 3L AS o_orderkey, TIMESTAMP_NTZ '1996-03-01 00:00:00' AS o_orderdate UNION ALL SELECT NULL, NULL").write.mode("append").parquet(f"{tables}/orders.parquet")
    written, plain = [], trips.landed_as

    def landed_as(df, path, mode="error"):
        written.append((plan_of(df), path))
        plain(df, path, mode)

    monkeypatch.setattr(trips, "landed_as", landed_as)
    monkeypatch.setattr(kinds, "landed_as", landed_as)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        land(spark, tables)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [path for plan, path in written if "Sort" in plan] == []
    staged, path = written[0]
    assert staged.count("Exchange hashpartitioning") == 2
    # 840 lines and 12 resent; the 7 lines of order 3 meet two orders.
    assert spark.read.parquet(path).where("batch = 1").count() == 847


def test_a_batch_of_bronze_is_written_without_a_sort(spark, tables, parted, tmp_path):
    schema = f"s_{tmp_path.name}"
    cfg = LakehouseConfig(trips.landing_zone(trips.land(spark, tables)), schema=schema, schema_location=f"{tmp_path}/lake")
    try:
        build_bronze(spark, cfg)
        assert [df.columns for df in parted if "total_amount" in df.columns and not df.isEmpty()] == []
        assert read_table(spark, cfg.table(cfg.bronze_name)).count() == 840
        assert len(partition_names(spark, cfg.table(cfg.bronze_name))) == 1
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


def test_one_partition_without_rows_is_none_and_takes_no_odd_names(spark, tmp_path):
    schema, by = f"s_{tmp_path.name}", {"partition_by": ["p"], "replace_partitions": True}
    create_schema(spark, schema, f"{tmp_path}/lake")
    rows = spark.range(3).withColumn("p", F.lit("a"))
    try:
        write_table(rows, f"{schema}.t", TableContract(()), "c", **by, one={"p": "a"})
        write_table(rows.limit(0), f"{schema}.t", TableContract(()), "c", **by, one={"p": "b"})
        assert partition_names(spark, f"{schema}.t") == ["p=a"]
        assert sorted(map(tuple, read_table(spark, f"{schema}.t").collect())) == [(0, "a"), (1, "a"), (2, "a")]
        with pytest.raises(ValueError, match="named by"):
            write_table(rows, f"{schema}.t", TableContract(()), "c", **by, one={"p": "a/b"})
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
