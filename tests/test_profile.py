from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faremill import RATECODES, VENDOR_CODES
from faremill import operators as ops


@pytest.fixture
def monthly(make_trips):
    """Silver-like rows of two months; the second has no positive amount."""
    jan, feb = datetime(2023, 1, 5, 7), datetime(2023, 2, 5, 7)
    rows = [
        {"tpep_pickup_datetime": jan, "total_amount": 10.0, "passenger_count": 2},
        {"tpep_pickup_datetime": jan, "total_amount": 20.0, "passenger_count": None, "RatecodeID": None},
        {"tpep_pickup_datetime": jan, "total_amount": -5.0, "passenger_count": 1},
        {"tpep_pickup_datetime": jan, "total_amount": 0.0, "passenger_count": 0, "VendorID": 7},
        {"tpep_pickup_datetime": feb, "total_amount": -3.0, "passenger_count": 3, "RatecodeID": 99},
    ]
    return ops.derive_calendar(make_trips(rows))


def test_null_profile_lists_only_columns_with_nulls(make_trips):
    df = make_trips([{"RatecodeID": None, "VendorID": None}, {"RatecodeID": None}, {}])
    got = [tuple(r) for r in ops.null_profile(df).collect()]
    assert got == [("RatecodeID", 2, 66.6667, 9), ("VendorID", 1, 33.3333, 9)]


def test_completeness_keeps_the_order_of_columns(make_trips):
    df = make_trips([{"passenger_count": None}, {}])
    got = ops.completeness(df, ["total_amount", "passenger_count"]).collect()
    assert [tuple(r) for r in got] == [(0, "total_amount", 0, 0.0, 2, 100.0), (1, "passenger_count", 1, 50.0, 1, 50.0)]


def test_simultaneous_nulls(make_trips):
    df = make_trips([{"passenger_count": None, "RatecodeID": None}, {"passenger_count": None}, {"RatecodeID": None}, {}])
    assert tuple(ops.simultaneous_nulls(df, ["passenger_count", "RatecodeID"]).first()) == (2, 1)


def test_group_share_denominators(make_trips):
    df = make_trips([{"VendorID": v, "total_amount": a} for v, a in [(1, -1.0), (1, 1.0), (2, -1.0), (2, -1.0), (3, 1.0)]])
    by, odd = {"VendorID": F.col("VendorID")}, F.col("total_amount") < 0
    total = ops.group_share(df, by, odd, of="total").orderBy("VendorID").collect()
    subset = ops.group_share(df, by, odd, of="subset", digits=2).orderBy("VendorID").collect()
    assert [tuple(r) for r in total] == [(1, 1, 20.0), (2, 2, 40.0)]
    assert [tuple(r) for r in subset] == [(1, 1, 33.33), (2, 2, 66.67)]
    with pytest.raises(ValueError):
        ops.group_share(df, by, odd, of="rest")


def test_group_share_of_nothing(make_trips):
    df = make_trips([{}]).filter("VendorID < 0")
    assert ops.group_share(df, {"VendorID": F.col("VendorID")}).collect() == []


def test_code_distribution_shows_null_and_unknown(monthly):
    got = [tuple(r) for r in ops.code_distribution(monthly, RATECODES).collect()]
    assert got == [(None, None, 1, 20.0), (1, "Standard rate", 3, 60.0), (99, "Outro/Inválido: 99", 1, 20.0)]
    assert sum(r.trips for r in ops.code_distribution(monthly, VENDOR_CODES).collect()) == monthly.count()


def test_anomaly_counts(monthly):
    rules = {"zero": F.col("passenger_count") == 0, "null": F.col("passenger_count").isNull()}
    assert [tuple(r) for r in ops.anomaly_counts(monthly, rules).collect()] == [(0, "zero", 1, 20.0), (1, "null", 1, 20.0)]


def test_interaction_of_the_two_filters(monthly):
    assert tuple(ops.filter_interaction(monthly).first()) == (1, 0, 2)


def test_null_code_origin(monthly):
    assert tuple(ops.null_code_origin(monthly).first()) == (1, 1, 0, 100.0, 0.0)
    coded = monthly.filter(F.col("RatecodeID").isNotNull())
    assert tuple(ops.null_code_origin(coded).first()) == (0, 0, 0, None, None)


def test_both_forms_of_chargeback_impact_drop_a_month_without_revenue(monthly):
    want = [(2023, 1, 25.0, 30.0, 5.0)]
    assert [tuple(r) for r in ops.chargeback_impact(monthly).collect()] == want
    assert [tuple(r) for r in ops.chargeback_impact_one_pass(monthly).collect()] == want


def test_monthly_profiles(monthly):
    assert [tuple(r) for r in ops.monthly_profile(monthly).collect()] == [
        (2023, 1, 4, 25.0, 6.25, -5.0, 20.0),
        (2023, 2, 1, -3.0, -3.0, -3.0, -3.0),
    ]
    assert [tuple(r) for r in ops.monthly_chargebacks(monthly).collect()] == [(2023, 1, 2, -5.0), (2023, 2, 1, -3.0)]


def test_hourly_profile_and_zero_impact(monthly):
    assert [tuple(r) for r in ops.hourly_profile(monthly, 2023, 1).collect()] == [(7, 2, 1.5, 3)]
    got = ops.avg_zero_impact(monthly, 2023, 1).first()
    assert tuple(got) == (4, 1, 1, 2, 25.0, 25.0, 50.0, 1.0, 1.5, -0.5)


def test_extremes_and_days(make_trips):
    days = [datetime(2008, 1, d, 5) for d in range(1, 15)]
    df = make_trips([{"tpep_pickup_datetime": d, "total_amount": float(d.day)} for d in reversed(days)])
    assert tuple(ops.metric_extremes(df).first()) == (1.0, 14.0)
    got = ops.daily_counts(df, "tpep_pickup_datetime", n=10).collect()
    assert [r.pickup_date.day for r in got] == list(range(1, 11))


def test_table_size(make_trips):
    assert tuple(ops.table_size(make_trips([{}, {}]), "x").first()) == ("x", 2, 11)
