"""Layer jobs from landed files to tables, over the trips made of the smallest tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from faremill import PeriodRange, plans
from faremill import operators as ops
from workload import queries as Q
from workload.trips import ORDER, RECORD_ID, WINDOW, trips


@pytest.fixture(scope="module")
def lake(spark):
    cfg = Q.lakehouse(spark, "/root/testdata/sf0.001")
    plans.build_silver(spark, cfg)
    plans.build_gold(spark, cfg)
    yield cfg
    spark.sql(f"DROP SCHEMA {cfg.schema} CASCADE")


def test_known_figures(spark, sf_dir):
    bronze, silver = trips(spark, sf_dir), Q.silver(spark, sf_dir)
    assert tuple(ops.duplicate_count(bronze).first())[:2] == (6080, 83)
    rules = {
        "time": ops.time_travel(),
        "out": WINDOW.excludes("tpep_pickup_datetime"),
        "null": F.col("passenger_count").isNull(),
        "zero": F.col("passenger_count") == 0,
        "negative": F.col("total_amount") < 0,
        "still": F.col("trip_distance") == 0,
    }
    got = [r.matched_rows for r in ops.anomaly_counts(bronze, rules).collect()]
    assert got == [418, 5707, 918, 874, 342, 294]
    total = silver.agg(F.count("*"), F.round(F.sum("total_amount"), 2), F.count_if(F.col("source_file_path") == "batch-2"))
    assert tuple(total.first()) == (358, 18883945.50, 0)
    assert tuple(ops.filter_interaction(silver).first()) == (47, 47, 7)
    assert tuple(ops.null_code_origin(silver).first())[:2] == (47, 47)
    revenue = [tuple(r)[2:] for r in plans.revenue_by_month(plans.gold(silver)).collect()]
    assert revenue == [(65, 3406395.26), (58, 3274601.93), (108, 5713582.99), (46, 2872628.26), (73, 3963992.82)]
    hourly = plans.avg_passengers_by_hour(plans.gold(silver), 1996, 5).collect()
    assert (len(hourly), sum(r.total_trips for r in hourly)) == (20, 54)


def test_column_counts_by_layer(spark, lake):
    extra = {*RECORD_ID, "l_linenumber", "cbd_fee", "ingest_batch"}
    width = {n: len(set(spark.table(lake.table(n)).columns) - extra) for n in ("taxi_bronze", "taxi_silver", "taxi_gold")}
    assert width == {"taxi_bronze": 21, "taxi_silver": 23, "taxi_gold": 13}


def test_tables_hold_what_the_plans_give(spark, sf_dir, lake):
    table = spark.table(lake.table("taxi_gold"))
    plan = Q.gold(spark, sf_dir).select(*table.columns)
    assert table.exceptAll(plan).count() == plan.exceptAll(table).count() == 0


def test_gold_has_every_silver_row(spark, lake):
    assert spark.table(lake.table("taxi_gold")).count() == spark.table(lake.table("taxi_silver")).count()


def test_rows_are_conserved(spark, lake):
    bronze = spark.table(lake.table("taxi_bronze"))
    keeps = {"time": ops.in_time_order(), "window": WINDOW.contains("tpep_pickup_datetime")}
    steps = ops.cleaning_waterfall(bronze, keeps, {}).collect()
    assert steps[-1].remaining_rows == spark.table(lake.table("taxi_silver")).count()
    assert sum(r.removed_rows for r in steps) == bronze.count() - steps[-1].remaining_rows


def test_filter_and_dedup_commute(spark, sf_dir):
    bronze = trips(spark, sf_dir)
    keep = ops.in_time_order() & WINDOW.contains("tpep_pickup_datetime")
    before = ops.first_per_key(bronze.filter(keep), order=ORDER)
    after = ops.first_per_key(bronze, order=ORDER).filter(keep)
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0


def test_rerun_gives_the_same_tables(spark, lake):
    before = sorted(map(tuple, plans.revenue_by_month(spark.table(lake.table("taxi_gold"))).collect()))
    plans.build_silver(spark, lake)
    plans.build_gold(spark, lake)
    again = spark.table(lake.table("taxi_gold"))
    assert sorted(map(tuple, plans.revenue_by_month(again).collect())) == before


def test_one_month_can_be_rebuilt_alone(spark, lake):
    before = sorted(map(tuple, plans.revenue_by_month(spark.table(lake.table("taxi_gold"))).collect()))
    march = replace(lake, window=PeriodRange.of([1996], [3]), replace_partitions=True)
    plans.build_silver(spark, march)
    plans.build_gold(spark, march)
    after = spark.table(lake.table("taxi_gold"))
    assert sorted(map(tuple, plans.revenue_by_month(after).collect())) == before


def test_default_ingestion_time_is_one_instant(spark, sf_dir, tmp_path):
    zone = Q.resent_zone(Q.land(spark, sf_dir))
    df = plans.bronze(spark, zone)
    assert df.select("etl_ingestion_timestamp").distinct().count() == 1
    assert dict(df.dtypes)["etl_ingestion_timestamp"] == "timestamp"


def test_all_jobs_in_a_row(spark, sf_dir, tmp_path):
    zone = Q.landing_zone(Q.land(spark, sf_dir))
    name = "whole_run"
    cfg = plans.LakehouseConfig(zone, schema=name, schema_location=str(tmp_path / name))
    plans.build_lakehouse(spark, cfg)
    gold = spark.table(cfg.table(cfg.gold_name))
    # The zone expects June as well, so its window is a month longer than the answers' one.
    assert gold.agg(F.min("month"), F.max("month")).first()[:] == (1, 6)
    assert gold.count() == spark.table(cfg.table(cfg.silver_name)).count() > 0
    spark.sql(f"DROP SCHEMA {name} CASCADE")
