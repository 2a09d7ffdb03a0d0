from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faremill import TRIP_CONTRACT, ColumnSpec, SchemaDriftError, TableContract
from faremill.operators import derive_calendar
from faremill.sinks import column_dictionary, create_schema, read_table, write_table


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{tmp_path.name.replace('-', '_')}"
    create_schema(spark, name, str(tmp_path / name))
    create_schema(spark, name)  # there already
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def table_comment(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r.data_type for r in rows if r.col_name == "Comment")


def months(make_trips, *pairs):
    rows = [{"tpep_pickup_datetime": datetime(2023, m, 1), "total_amount": a} for m, a in pairs]
    return derive_calendar(make_trips(rows))


def test_descriptions_are_stored_unchanged(spark, schema):
    contract = TableContract((ColumnSpec("id", TRIP_CONTRACT.find("VendorID").data_type, "driver's \\ id"),))
    table = f"{schema}.t"
    write_table(spark.range(3).withColumn("other", F.lit(1)), table, contract, "it's a 'table' \\ here")
    assert table_comment(spark, table) == "it's a 'table' \\ here"
    assert [(r.column_name, r.comment) for r in column_dictionary(spark, table).collect()] == [
        ("id", "driver's \\ id"),
        ("other", None),
    ]


def test_partition_columns_are_described_too(spark, schema, make_trips):
    table = f"{schema}.t"
    write_table(months(make_trips, (1, 1.0)), table, TRIP_CONTRACT, "c", partition_by=["year", "month"])
    words = {r.column_name: r.comment for r in column_dictionary(spark, table).collect()}
    assert words["year"] == TRIP_CONTRACT.find("year").comment
    assert words["VendorID"] == TRIP_CONTRACT.find("VendorID").comment


def test_overwrite_twice_gives_the_same_table(spark, schema, make_trips):
    table, df = f"{schema}.t", months(make_trips, (1, 1.0), (2, 2.0))
    for rebalance in (False, True):
        write_table(df, table, TRIP_CONTRACT, "c", partition_by=["year", "month"], rebalance=rebalance)
        got = read_table(spark, table).select("month", "total_amount").collect()
        assert sorted(map(tuple, got)) == [(1, 1.0), (2, 2.0)]


def test_append_fills_absent_columns_and_refuses_new_ones(spark, schema, make_trips):
    table, df = f"{schema}.t", make_trips([{"total_amount": 1.0}])
    write_table(df, table, TRIP_CONTRACT, "c")
    write_table(make_trips([{"total_amount": 2.0}]).drop("RatecodeID"), table, TRIP_CONTRACT, "c", mode="append")
    got = read_table(spark, table).select("total_amount", "RatecodeID").collect()
    assert sorted(map(tuple, got)) == [(1.0, 1), (2.0, None)]
    with pytest.raises(SchemaDriftError, match="novel"):
        write_table(df.withColumn("novel", F.lit(1)), table, TRIP_CONTRACT, "c", mode="append")


def test_replacing_partitions_leaves_the_other_months(spark, schema, make_trips):
    table = f"{schema}.t"
    options = dict(partition_by=["year", "month"], replace_partitions=True)
    write_table(months(make_trips, (1, 1.0), (2, 2.0)), table, TRIP_CONTRACT, "c", **options)
    write_table(months(make_trips, (2, 5.0)), table, TRIP_CONTRACT, "c", **options)
    got = read_table(spark, table).select("month", "total_amount").collect()
    assert sorted(map(tuple, got)) == [(1, 1.0), (2, 5.0)]


def test_error_mode_refuses_an_existing_table(spark, schema, make_trips):
    table, df = f"{schema}.t", make_trips([{}])
    write_table(df, table, TRIP_CONTRACT, "c", mode="error", provider="orc")
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_table(df, table, TRIP_CONTRACT, "c", mode="error")
    assert "orc" in str(spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()).lower()
