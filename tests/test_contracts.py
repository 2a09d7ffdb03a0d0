from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, TimestampNTZType, TimestampType

from faremill import TRIP_CONTRACT, PeriodRange


def test_window_covers_first_to_last_month():
    w = PeriodRange.of(["2023"], ["01", "02", "03", "04", "05"])
    assert (w.start, w.end) == (datetime(2023, 1, 1), datetime(2023, 6, 1))


def test_window_ends_in_december():
    assert PeriodRange.of([2023], [12]).end == datetime(2024, 1, 1)


def test_window_over_several_years():
    w = PeriodRange.of([2024, 2022], [11, 3])
    assert (w.start, w.end) == (datetime(2022, 3, 1), datetime(2024, 12, 1))


def test_window_needs_a_period():
    with pytest.raises(ValueError):
        PeriodRange.of([], [1])


def test_window_bounds_are_half_open(make_trips):
    w = PeriodRange.of([2023], [1, 2])
    times = [datetime(2022, 12, 31, 23, 59, 59), w.start, datetime(2023, 2, 28, 23, 59, 59), w.end]
    df = make_trips([{"tpep_pickup_datetime": t} for t in times])
    kept = df.filter(w.contains("tpep_pickup_datetime")).select("tpep_pickup_datetime").collect()
    assert sorted(r[0] for r in kept) == times[1:3]
    out = df.filter(w.excludes("tpep_pickup_datetime")).select("tpep_pickup_datetime").collect()
    assert sorted(r[0] for r in out) == [times[0], times[3]]


def test_covers_is_the_window_on_year_and_month(spark):
    w = PeriodRange.of([2022, 2023], [11, 12, 1, 2])
    months = spark.range(36).select((2021 + F.col("id") / 12).cast("int").alias("year"), (F.col("id") % 12 + 1).alias("month"))
    got = {(r.year, r.month) for r in months.filter(w.covers("year", "month")).collect()}
    assert got == {(2022, m) for m in range(1, 13)} | {(2023, m) for m in range(1, 13)}


def test_numbers_and_times_convert_and_text_does_not():
    passengers = TRIP_CONTRACT.find("passenger_count")
    assert all(passengers.accepts(t) for t in (DoubleType(), IntegerType(), LongType()))
    assert not passengers.accepts(StringType())
    pickup = TRIP_CONTRACT.find("tpep_pickup_datetime")
    assert pickup.accepts(TimestampType()) and pickup.accepts(TimestampNTZType())
    assert not pickup.accepts(LongType())


def test_contract_has_each_column_once_and_finds_any_case():
    names = [c.name.lower() for c in TRIP_CONTRACT.columns]
    assert len(names) == len(set(names)) == 28
    assert TRIP_CONTRACT.find("Airport_fee").name == "airport_fee"
    assert len(TRIP_CONTRACT.struct().fields) == 19


def test_describe_leaves_unknown_columns_alone(spark):
    df = TRIP_CONTRACT.describe(spark.range(1).select(F.lit(1).alias("VendorID"), F.lit(2).alias("other")))
    assert df.schema["VendorID"].metadata["comment"] == TRIP_CONTRACT.find("VendorID").comment
    assert df.schema["other"].metadata == {}
