"""Group shares in all three forms read their table once; fractions that no integer holds become NULL."""

import pytest
from conftest import executed_nodes
from pyspark.sql import functions as F

from faremill import operators as ops
from faremill.contracts import SECONDARY_FIELDS, TRIP_CONTRACT
from faremill.operators.profile import group_share, grouped_profile
from faremill.sources import conform
from workload import queries as Q


@pytest.mark.parametrize(("among", "of"), [(False, "total"), (True, "total"), (True, "subset")])
def test_group_share_scans_once(spark, tmp_path, among, of):
    spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("v")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    out = group_share(table, {"k": F.col("k")}, among=F.col("v") == 0 if among else None, of=of)
    rows = out.collect()
    whole = 1000 if of == "total" else 334
    assert len(rows) == 7 and all(r[2] == pytest.approx(100 * r[1] / whole, abs=1e-4) for r in rows)
    nodes = [name for name, _ in executed_nodes(out)]
    assert nodes.count("FileSourceScanExec") == 1


def test_numbers_that_no_integer_holds_become_null(spark):
    values = [2.9, float("nan"), float("inf"), -float("inf"), 1e300, None]
    landed = spark.createDataFrame([(v,) for v in values], "passenger_count double")
    got = [r[0] for r in conform(landed, TRIP_CONTRACT).collect()]
    assert got == [2, None, None, None, None, None]


def test_grouped_profile_scans_once_and_agrees_with_the_single_profiles(spark, tmp_path, make_trips):
    rows = [{"VendorID": i % 3, "RatecodeID": None if i % 5 == 0 else i % 2, "total_amount": float(i - 20), "passenger_count": i % 4 or None} for i in range(60)]
    make_trips(rows).withColumns({c: F.lit(1.0) for c in ("congestion_surcharge", "airport_fee")}).withColumn("store_and_fwd_flag", F.lit("N")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    rules = {"negative": F.col("total_amount") < 0, "no_rate": F.col("RatecodeID").isNull()}
    out = grouped_profile(table, rules)
    got = out.collect()
    assert [name for name, _ in executed_nodes(out)].count("FileSourceScanExec") == 1
    (whole,) = (r for r in got if r.grouping == "all")
    assert [whole.negative, whole.no_rate] == [r.matched_rows for r in ops.anomaly_counts(table, rules).collect()]
    assert (whole.min_value, whole.max_value) == tuple(ops.metric_extremes(table).first())
    assert whole.null_passenger_count == ops.simultaneous_nulls(table, ["passenger_count"]).first().null_rows
    for code in ("VendorID", "RatecodeID", "payment_type"):
        single = {r[0]: r.trips for r in group_share(table, {code: F.col(code)}, rules["negative"], of="total").collect()}
        assert {r.code: r.negative for r in got if r.grouping == code and r.negative} == single
    days = {r.pickup_date: r.trips for r in ops.daily_counts(table, "tpep_pickup_datetime").collect()}
    assert {r.pickup_date: r.rows for r in got if r.grouping == "pickup_date"} == days


def test_the_workload_tells_one_missing_field_from_all(spark, sf_dir):
    matched = {r.rule: r.matched_rows for r in Q.cleaning_waterfall(spark, sf_dir).collect()}
    one = [Q.trips(spark, sf_dir).where(F.col(c).isNull()).count() for c in SECONDARY_FIELDS]
    assert 0 < matched["systemic_nulls"] == min(one) < max(one)
