from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from faremill import PeriodRange
from faremill import operators as ops
from faremill.operators.clean import survivor_order

T = datetime(2023, 1, 10, 8)
WINDOW = PeriodRange.of([2023], [1])
KEEPS = {"time": ops.in_time_order, "window": lambda: WINDOW.contains("tpep_pickup_datetime")}


def waterfall(df, notes=None):
    keeps = {name: cond() for name, cond in KEEPS.items()}
    return {r.rule: r for r in ops.cleaning_waterfall(df, keeps, notes or {}).collect()}


def test_equal_times_stay_and_null_dropoff_goes(make_trips):
    df = make_trips(
        [
            {"tpep_dropoff_datetime": T, "PULocationID": 1},
            {"tpep_dropoff_datetime": T - timedelta(seconds=1), "PULocationID": 2},
            {"tpep_dropoff_datetime": None, "PULocationID": 3},
            {"tpep_pickup_datetime": None, "PULocationID": 4},
        ]
    )
    assert [r.PULocationID for r in df.filter(ops.in_time_order()).collect()] == [1]
    assert [r.PULocationID for r in df.filter(ops.time_travel()).collect()] == [2]


def test_oldest_ingestion_survives(make_trips):
    late, early = datetime(2023, 6, 2), datetime(2023, 6, 1)
    df = make_trips(
        [
            {"etl_ingestion_timestamp": late, "total_amount": -10.0, "source_file_path": "a"},
            {"etl_ingestion_timestamp": early, "total_amount": 10.0, "source_file_path": "b"},
        ]
    )
    assert [r.total_amount for r in ops.first_per_key(df).collect()] == [10.0]


def test_tie_is_broken_the_same_way_for_any_input_order(make_trips):
    rows = [{"total_amount": float(a), "source_file_path": p} for a, p in [(5, "b"), (-5, "a"), (7, "a"), (7, "c")]]
    for shuffled in (rows, rows[::-1], rows[2:] + rows[:2]):
        for partitions in (1, 3):
            kept = ops.first_per_key(make_trips(shuffled).repartition(partitions)).collect()
            assert [(r.source_file_path, r.total_amount) for r in kept] == [("a", -5.0)]


def test_default_order_ends_in_every_other_column(make_trips):
    df = make_trips([{}])
    order = survivor_order(df)
    assert order[:2] == ["etl_ingestion_timestamp", "source_file_path"]
    assert {c.lower() for c in order} | {"vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "dolocationid"} == {c.lower() for c in df.columns}


def test_null_key_is_one_group(make_trips):
    df = make_trips([{"VendorID": None}, {"VendorID": None, "total_amount": 3.0}, {"VendorID": 1}])
    assert ops.first_per_key(df).count() == 2
    assert tuple(ops.duplicate_count(df).first())[:3] == (3, 1, 2)


def test_duplicate_count_of_nothing(make_trips):
    empty = make_trips([{}]).filter("VendorID < 0")
    assert tuple(ops.duplicate_count(empty).first()) == (0, 0, 0, None)


def test_duplicate_examples_are_the_first_by_key_and_rank(make_trips):
    rows = [{"PULocationID": p, "total_amount": float(i)} for p in (3, 1, 2) for i in range(4)]
    got = ops.duplicate_examples(make_trips(rows), ["total_amount"], n=5).collect()
    assert [(r.PULocationID, r.occurrence, r.total_amount) for r in got] == [
        (1, 2, 1.0),
        (1, 3, 2.0),
        (1, 4, 3.0),
        (2, 2, 1.0),
        (2, 3, 2.0),
    ]


def test_duplicate_examples_from_one_big_group(make_trips):
    df = make_trips([{"total_amount": float(i)} for i in range(50)])
    got = ops.duplicate_examples(df, ["total_amount"], n=5).collect()
    assert [(r.occurrence, r.total_amount) for r in got] == [(i + 1, float(i)) for i in range(1, 6)]


def test_calendar_reads_the_clock_as_it_is(spark, make_trips):
    df = make_trips([{"tpep_pickup_datetime": datetime(2023, 12, 31, 23, 59, 59)}])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = ops.derive_calendar(df, parts=["year", "month", "pickup_hour"]).select("year", "month", "pickup_hour")
            assert tuple(got.first()) == (2023, 12, 23)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_waterfall_adds_up(make_trips):
    out = datetime(2008, 1, 1)
    rows = [{"PULocationID": i} for i in range(5)]
    rows += [{"PULocationID": 0, "total_amount": -1.0}]  # repeat
    rows += [{"PULocationID": 6, "tpep_dropoff_datetime": T - timedelta(hours=1)}] * 2  # time travel, sent twice
    rows += [{"PULocationID": 7, "tpep_pickup_datetime": out, "tpep_dropoff_datetime": out}]
    rows += [{"PULocationID": 8, "tpep_pickup_datetime": out, "tpep_dropoff_datetime": out - timedelta(hours=1)}]
    rows += [{"PULocationID": 9, "tpep_dropoff_datetime": None}]
    df = make_trips(rows)
    got = waterfall(df, {"negative": F.col("total_amount") < 0})
    assert [(r.matched_rows, r.removed_rows, r.remaining_rows, r.effect) for r in got.values()] == [
        (2, 2, 9, "removes"),
        (4, 3, 6, "removes"),  # both copies of one, one out of the window too, one without a dropoff
        (2, 1, 5, "removes"),
        (1, 0, 5, "keeps"),
    ]
    kept = ops.first_per_key(df.filter(ops.in_time_order() & WINDOW.contains("tpep_pickup_datetime")))
    assert kept.count() == got["window"].remaining_rows


def test_waterfall_of_nothing(make_trips):
    got = waterfall(make_trips([{}]).filter("VendorID < 0"))
    assert {(r.matched_rows, r.remaining_rows, r.pct_removed) for r in got.values()} == {(0, 0, None)}


def test_waterfall_refuses_a_rule_outside_the_key(make_trips):
    with pytest.raises(AnalysisException):
        ops.cleaning_waterfall(make_trips([{}]), {"paid": F.col("total_amount") > 0}, {})
