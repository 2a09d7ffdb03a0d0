"""Properties of the cleaning operators on random trips, and their behaviour under skew."""

from datetime import datetime, timedelta

import pytest
from conftest import executed_nodes
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremill import PeriodRange
from faremill import operators as ops
from faremill.operators.clean import survivor_order

WINDOW = PeriodRange.of([2023], [1, 2])
T = datetime(2023, 1, 30)

trip = st.fixed_dictionaries(
    {
        "VendorID": st.sampled_from([None, 1, 2]),
        "tpep_pickup_datetime": st.sampled_from([None, T, T + timedelta(days=1), T + timedelta(days=60)]),
        "tpep_dropoff_datetime": st.sampled_from([None, T - timedelta(hours=1), T, T + timedelta(days=90)]),
        "PULocationID": st.sampled_from([None, 1]),
        "total_amount": st.sampled_from([None, -1.0, 0.0, 1.0]),
        "passenger_count": st.sampled_from([None, 0, 1]),
        "etl_ingestion_timestamp": st.sampled_from([datetime(2023, 6, 1), datetime(2023, 6, 2)]),
        "source_file_path": st.sampled_from(["a", "b"]),
    }
)
KEY = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"]


def nulls_first(values):
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


def brute_first(rows, order):
    best = {}
    for r in rows:
        k = tuple(r[c] for c in KEY)
        rank = nulls_first(r[c] for c in order)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, r)
    return sorted((tuple(r) for _, r in best.values()), key=nulls_first)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(trip, min_size=1, max_size=30))
def test_cleaning_properties(make_trips, rows):
    df = make_trips(rows)
    bronze = df.collect()
    once = ops.first_per_key(df)
    got = sorted(map(tuple, once.collect()), key=nulls_first)
    assert got == brute_first(bronze, survivor_order(df))
    assert sorted(map(tuple, ops.first_per_key(once).collect()), key=nulls_first) == got
    assert sorted(map(tuple, ops.first_per_key(make_trips(rows[::-1]).repartition(3)).collect()), key=nulls_first) == got

    counted = ops.duplicate_count(df).first()
    assert (counted.total_rows, counted.unique_rows) == (len(rows), len(got))

    keeps = {"time": ops.in_time_order(), "window": WINDOW.contains("tpep_pickup_datetime")}
    steps = ops.cleaning_waterfall(df, keeps, {"neg": F.col("total_amount") < 0}).collect()
    kept = ops.first_per_key(df.filter(keeps["time"] & keeps["window"])).count()
    assert steps[2].remaining_rows == kept
    assert sum(s.removed_rows for s in steps) == len(rows) - kept
    assert steps[3].matched_rows == sum(r.total_amount is not None and r.total_amount < 0 for r in bronze)


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 trips over many files' worth of tasks; one key holds a third of them."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    at = F.timestamp_seconds(F.lit(1_673_000_000) + F.when(hot, 0).otherwise(F.col("id")))
    return (
        spark.range(0, n, 1, 12)
        .select(
            F.lit(1).cast("long").alias("VendorID"),
            at.cast("timestamp_ntz").alias("tpep_pickup_datetime"),
            at.cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
            F.lit(1).cast("long").alias("PULocationID"),
            F.lit(2).cast("long").alias("DOLocationID"),
            (F.lit(n) - F.col("id")).cast("double").alias("total_amount"),
            F.lit("a").alias("source_file_path"),
            F.lit(datetime(2023, 6, 1)).cast("timestamp_ntz").alias("etl_ingestion_timestamp"),
        )
    )


def shuffled_rows(df):
    """Rows written to each of the plan's shuffles."""
    df.collect()
    shuffles = [node for name, node in executed_nodes(df) if name == "ShuffleExchangeExec"]
    return [node.metrics().apply("shuffleRecordsWritten").value() for node in shuffles]


def test_hot_key_sends_one_row_per_task(skewed):
    unique = 40_001
    kept = ops.first_per_key(skewed)
    assert max(shuffled_rows(kept)) <= unique + 12
    assert kept.count() == unique
    hot = kept.filter(F.col("tpep_pickup_datetime") == F.timestamp_seconds(F.lit(1_673_000_000)).cast("timestamp_ntz"))
    assert [r.total_amount for r in hot.collect()] == [3.0]  # the smallest amount of the tied rows


def test_hot_key_is_combined_before_the_count(skewed):
    counted = ops.duplicate_count(skewed)
    assert max(shuffled_rows(counted)) <= 40_001 + 12
    assert tuple(counted.first())[:3] == (60_000, 19_999, 40_001)


def test_hot_key_examples_are_whole(skewed):
    got = ops.duplicate_examples(skewed, ["total_amount"], n=5)
    assert max(shuffled_rows(got)) <= 40_001 + 12 * 6
    assert [(r.occurrence, r.total_amount) for r in got.collect()] == [(2, 6.0), (3, 9.0), (4, 12.0), (5, 15.0), (6, 18.0)]
