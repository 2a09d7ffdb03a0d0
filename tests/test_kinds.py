"""Other types of record by configuration only: roles, kinds, and what a missing part means."""

from dataclasses import replace
from datetime import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from faremill import GREEN_TRIPS, YELLOW_TRIPS, MissingRoleError, PeriodRange, Roles, plans
from faremill.plans.layers import LakehouseConfig
from faremill.sources import LandingZone
from workload import kinds
from workload.kinds import EVENT_KIND

WINDOW = PeriodRange.of([2023], [1])
SCHEMA = "id bigint, who bigint, started timestamp_ntz, ended timestamp_ntz, seats bigint, paid double, source_file_path string, etl_ingestion_timestamp timestamp_ntz"


def at(day, hour):
    return datetime(2023, 1, day, hour)


@pytest.fixture
def rides(spark):
    rows = [
        (1, 7, at(1, 8), at(1, 9), 2, 10.0, "a", at(9, 0)),
        (2, 7, at(1, 8), at(1, 9), 5, -10.0, "b", at(9, 1)),  # sent again
        (3, 7, at(2, 8), at(2, 7), 1, 5.0, "a", at(9, 0)),  # ends before it starts
        (4, 8, datetime(2022, 12, 31, 23), at(1, 0), 1, 5.0, "a", at(9, 0)),  # before the window
        (5, None, at(3, 8), at(3, 8), 4, 2.5, "a", at(9, 0)),
        (6, 8, at(3, 9), None, 4, 2.5, "a", at(9, 0)),  # no end
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_layers_and_answers_by_other_names(rides):
    roles = Roles("started", "ended", "seats", "paid")
    silver = plans.silver(rides, WINDOW, ("who", "started", "ended"), roles=roles)
    assert sorted(r.id for r in silver.collect()) == [1, 5]
    gold = plans.gold(silver, ("id", "started", "seats", "paid", "year", "month"), (), roles)
    assert gold.columns[-1] == "pickup_hour"
    assert [tuple(r) for r in plans.revenue_by_month(gold, roles).collect()] == [(2023, 1, 2, 12.5)]
    assert [tuple(r) for r in plans.avg_passengers_by_hour(gold, 2023, 1, roles=roles).collect()] == [(8, 3.0, 2)]
    assert plans.revenue_report(gold, roles).collect() == plans.revenue_report_sql(gold, roles).collect()
    for query in (plans.hour_extremes, plans.hours_wide, plans.daypart_profile):
        assert query(gold, 2023, 1, roles=roles).count() == 1


def test_without_a_dropoff_no_time_order(rides):
    silver = plans.silver(rides, WINDOW, ("who", "started"), roles=Roles("started"))
    assert sorted(r.id for r in silver.collect()) == [1, 3, 5, 6]


def test_an_answer_without_its_part_fails_before_a_job(rides):
    with pytest.raises(MissingRoleError, match="amount"):
        plans.revenue_by_month(rides, Roles("started"))
    with pytest.raises(MissingRoleError, match="passengers"):
        plans.avg_passengers_by_hour(rides, 2023, 1, roles=Roles("started"))


def test_a_kind_whose_key_lacks_a_time_is_refused():
    with pytest.raises(ValueError, match="lpep_dropoff_datetime"):
        replace(GREEN_TRIPS, key=GREEN_TRIPS.key[:2])
    with pytest.raises(ValueError, match="no columns"):
        replace(GREEN_TRIPS, columns=("tpep_pickup_datetime",))


def test_green_contract_has_its_own_columns():
    yellow, green = ({c.name for c in k.contract.columns} for k in (YELLOW_TRIPS, GREEN_TRIPS))
    assert green - yellow == {"lpep_pickup_datetime", "lpep_dropoff_datetime", "ehail_fee", "trip_type", "trip_type_desc"}
    assert yellow - green == {"tpep_pickup_datetime", "tpep_dropoff_datetime", "airport_fee"}


def test_of_kind_reads_its_own_periods_and_names_its_tables():
    zone = LandingZone("/landing", ["yellow", "green"], [2023], [1])
    cfg = LakehouseConfig.of_kind(GREEN_TRIPS, zone, schema="s")
    assert [p.kind for p in cfg.zone.expected()] == ["green"]
    assert cfg.table(cfg.gold_name) == "s.green_gold" and cfg.roles.pickup == "lpep_pickup_datetime"


@pytest.mark.parametrize("name, pickup", [("green", "lpep_pickup_datetime"), ("events", "ts")])
def test_silver_of_a_kind_is_one_shuffle_and_pushes_its_window(spark, sf_dir, name, pickup):
    cfg = kinds.lake_of(spark, sf_dir, name)
    plan = plan_of(plans.silver(kinds.bronze_of(spark, sf_dir, name), cfg.valid, cfg.key, cfg.order, cfg.roles))
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and f"GreaterThanOrEqual({pickup}" in below


def test_missing_columns_of_a_kind_are_filled_and_comments_kept(spark, sf_dir):
    bronze = kinds.bronze_of(spark, sf_dir, "green")
    assert bronze.where(F.col("ehail_fee").isNotNull()).count() == 0 and "airport_fee" not in bronze.columns
    gold = kinds.gold_of(spark, sf_dir, "events")
    assert gold.schema["items"].metadata["comment"] == EVENT_KIND.contract.find("items").comment
