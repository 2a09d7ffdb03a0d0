"""Physical plans: what reaches the scan, how often data is scanned and shuffled."""

import pytest
from conftest import executed_nodes, plan_of

from faremill import operators as ops
from faremill import plans
from workload import queries as Q
from workload.trips import trips


@pytest.fixture(scope="module")
def lake(spark):
    cfg = Q.lakehouse(spark, "/root/testdata/sf0.001")
    plans.build_silver(spark, cfg)
    plans.build_gold(spark, cfg)
    yield cfg
    spark.sql(f"DROP SCHEMA {cfg.schema} CASCADE")


def run(df):
    df.collect()
    return [name for name, _ in executed_nodes(df)]


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_in_any_plan(spark, sf_dir, name):
    plan = plan_of(Q.QUERIES[name](spark, sf_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_dedup_cuts_each_key_before_the_shuffle(spark, lake):
    bronze = spark.table(lake.table("taxi_bronze"))
    plan = plan_of(plans.silver(bronze, lake.valid))
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in below and "LessThan(tpep_pickup_datetime" in below


def test_examples_cut_each_key_before_the_shuffle(spark, lake):
    plan = plan_of(ops.duplicate_examples(spark.table(lake.table("taxi_bronze")), ["total_amount"], n=5))
    assert "TakeOrderedAndProject" in plan
    assert "row_number(), 6, Partial" in plan.split("Exchange hashpartitioning")[1]


def test_gold_is_written_without_a_shuffle(spark, lake):
    assert "Exchange" not in plan_of(plans.gold(spark.table(lake.table("taxi_silver"))))


def test_answers_prune_partitions_and_columns(spark, lake):
    gold = spark.table(lake.table("taxi_gold"))
    plan = plan_of(plans.avg_passengers_by_hour(gold, 1996, 5))
    assert "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThan(passenger_count,0)" in plan
    assert "ReadSchema: struct<passenger_count:bigint,pickup_hour:int>" in plan
    revenue = plan_of(plans.revenue_by_month(gold))
    assert "GreaterThan(total_amount,0.0)" in revenue and "ReadSchema: struct<total_amount:double>" in revenue


@pytest.mark.parametrize(
    "profile",
    [
        ops.null_profile,
        ops.completeness,
        ops.simultaneous_nulls,
        ops.filter_interaction,
        ops.null_code_origin,
        ops.duplicate_count,
        ops.chargeback_impact_one_pass,
        ops.monthly_profile,
        lambda df: ops.avg_zero_impact(df, 1996, 5),
        lambda df: ops.code_distribution(df, ops.enrich.TRIP_CODES[0]),
        plans.revenue_report,
        plans.period_means,
    ],
)
def test_profiles_scan_their_table_once(spark, lake, profile):
    nodes = run(profile(spark.table(lake.table("taxi_silver"))))
    assert nodes.count("FileSourceScanExec") == 1


def test_waterfall_is_one_scan_and_one_shuffle_by_key(spark, lake):
    bronze = spark.table(lake.table("taxi_bronze"))
    keeps = {"time": ops.in_time_order(), "window": lake.valid.contains("tpep_pickup_datetime")}
    nodes = run(ops.cleaning_waterfall(bronze, keeps, {}))
    # the second exchange brings one partial row per task together
    assert nodes.count("FileSourceScanExec") == 1 and nodes.count("ShuffleExchangeExec") == 2


def test_month_rebuild_reads_only_its_partitions(spark, lake):
    march = type(lake.valid).of([1996], [3])
    silver = spark.table(lake.table("taxi_silver")).filter(march.covers("year", "month"))
    silver.collect()
    plan = plan_of(silver)
    assert "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_trips_are_one_join_whatever_the_batches(spark, sf_dir):
    plan = plan_of(trips(spark, sf_dir))
    assert plan.count("FileScan") == 2 and plan.count("Join") == 1
