"""Overwrites that readers survive, and ingests that can be repeated."""

import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faremill import TRIP_CONTRACT, NoLandedPeriodsError, SchemaDriftError, plans
from faremill.sinks import create_schema, ingest, staging, tables, write_table
from faremill.sources import LandingZone

OPTIONS = dict(contract=TRIP_CONTRACT, comment="c", partition_by=("year", "month"))


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s_{tmp_path.name.replace('-', '_')}"
    create_schema(spark, name, str(tmp_path / name))
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def rows(spark, *pairs):
    return spark.createDataFrame([(n, 2023, m) for m, n in pairs], "n long, year int, month int")


def held(spark, table):
    return sorted((r.month, r.n) for r in spark.table(table).collect())


def staged(tmp_path, schema, table="t"):
    """The partition folders that are staged below the table."""
    root = tmp_path / schema / table
    return sorted(f"{y}/{m}" for s in os.listdir(root) if s.startswith("_stage-") for y in os.listdir(root / s) if "=" in y for m in os.listdir(root / s / y))


def broken(*_, **__):
    raise RuntimeError("the job was ended")


def failing(df):
    """The rows, and a task that fails after some of them were written."""
    return df.unionByName(df.withColumn("n", F.expr("n + CAST(raise_error('ended') AS LONG)")))


@pytest.mark.parametrize("one_month", [False, True])
def test_a_write_that_ends_half_way_leaves_the_table(spark, schema, tmp_path, one_month):
    table = f"{schema}.t"
    write_table(rows(spark, (1, 1), (2, 2)), table, **OPTIONS)
    with pytest.raises(Exception, match="ended"):
        write_table(failing(rows(spark, (1, 10), (2, 20))), table, **OPTIONS, replace_partitions=one_month)
    assert held(spark, table) == [(1, 1), (2, 2)]
    write_table(rows(spark, (1, 11), (2, 22)), table, **OPTIONS, replace_partitions=one_month)
    assert held(spark, table) == [(1, 11), (2, 22)]
    # What was written and what it replaced; the broken-off write's files are gone.
    assert staged(tmp_path, schema) == ["year=2023/month=1"] * 2 + ["year=2023/month=2"] * 2


def test_a_write_that_ends_before_the_switch_leaves_the_table(spark, schema, monkeypatch):
    table = f"{schema}.t"
    write_table(rows(spark, (1, 1)), table, **OPTIONS)
    with monkeypatch.context() as m:
        m.setattr(tables, "switch", broken)
        with pytest.raises(RuntimeError):
            write_table(rows(spark, (1, 10), (3, 30)), table, **OPTIONS)
    assert held(spark, table) == [(1, 1)]


def test_a_first_write_that_ends_can_be_repeated(spark, schema):
    table = f"{schema}.t"
    with pytest.raises(Exception, match="ended"):
        write_table(failing(rows(spark, (1, 10))), table, **OPTIONS)
    write_table(rows(spark, (1, 1)), table, **OPTIONS)
    assert held(spark, table) == [(1, 1)]


def test_a_running_reader_keeps_its_files_for_one_write(spark, schema):
    table = f"{schema}.t"
    write_table(rows(spark, (1, 1), (2, 2)), table, **OPTIONS)
    files = spark.table(table).inputFiles()
    write_table(rows(spark, (1, 10)), table, **OPTIONS, replace_partitions=True)
    assert all(os.path.exists(f.removeprefix("file://")) for f in files)
    assert held(spark, table) == [(1, 10), (2, 2)]
    write_table(rows(spark, (1, 100)), table, **OPTIONS, replace_partitions=True)
    kept = [os.path.exists(f.removeprefix("file://")) for f in files]
    assert kept == ["month=2" in f for f in files] and held(spark, table) == [(1, 100), (2, 2)]


def test_the_overwritten_table_has_only_the_new_partitions(spark, schema):
    table = f"{schema}.t"
    write_table(rows(spark, (1, 1), (2, 2)), table, **OPTIONS)
    write_table(rows(spark, (2, 20), (3, 30)), table, **OPTIONS)
    assert held(spark, table) == [(2, 20), (3, 30)]
    write_table(rows(spark), table, **OPTIONS)
    assert held(spark, table) == []
    write_table(rows(spark, (1, 5)).withColumn("more", F.lit("x")), table, **OPTIONS)
    assert held(spark, table) == [(1, 5)] and spark.table(table).first().more == "x"


def test_partitions_of_text_with_odd_characters_and_null(spark, schema):
    table, odd = f"{schema}.t", ["a b", "x/y", "50%", "it's", "ü", "q=1", None]
    put = dict(contract=TRIP_CONTRACT, comment="c", partition_by=("part",))
    for add in (0, 100):
        write_table(spark.createDataFrame([(i + add, p) for i, p in enumerate(odd)], "n long, part string"), table, **put)
        assert {(r.n, r.part) for r in spark.table(table).collect()} == {(i + add, p) for i, p in enumerate(odd)}
    few = spark.createDataFrame([(7, "x/y"), (8, None)], "n long, part string")
    write_table(few, table, **put, replace_partitions=True, emptied=F.col("part").isin("50%", "ü"))
    left = {p: i + 100 for i, p in enumerate(odd) if p not in ("50%", "ü")} | {"x/y": 7, None: 8}
    assert {r.part: r.n for r in spark.table(table).collect()} == left


def test_the_session_keeps_its_overwrite_mode(spark, schema):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    write_table(rows(spark, (1, 1)), f"{schema}.t", **OPTIONS)
    write_table(rows(spark, (1, 2)), f"{schema}.t", **OPTIONS, replace_partitions=True)
    assert spark.conf.get(key) == before


# --- ingest -----------------------------------------------------------------------------------------------------------


@pytest.fixture
def zone(tmp_path):
    return LandingZone(str(tmp_path / "la nding"), ["yellow"], [2023], [1, 2, 3])


@pytest.fixture
def cfg(spark, zone, tmp_path):
    name = f"i_{tmp_path.name.replace('-', '_')}"
    yield plans.LakehouseConfig(zone, schema=name, schema_location=str(tmp_path / name))
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


@pytest.fixture
def land(zone, make_trips):
    def write(month, amount, mode="error", **columns):
        path = next(p.path for p in zone.expected() if p.month == month)
        df = make_trips([{"tpep_pickup_datetime": datetime(2023, month, 2, i), "total_amount": amount} for i in range(2)])
        df.drop("source_file_path", "etl_ingestion_timestamp").withColumns(columns).coalesce(1).write.mode(mode).parquet(path)

    return write


def bronze(spark, cfg):
    rows = spark.table(cfg.table(cfg.bronze_name)).groupBy(F.month("tpep_pickup_datetime").alias("m"), "total_amount").count().collect()
    return sorted((r["m"], r["total_amount"], r["count"]) for r in rows)


def test_the_same_zone_appended_again_changes_nothing(spark, cfg, land):
    land(1, 1.0)
    land(2, 2.0)
    assert plans.build_bronze(spark, cfg, mode="append") == 2
    files = spark.table(cfg.table(cfg.bronze_name)).inputFiles()
    assert plans.build_bronze(spark, cfg, mode="append") == 0
    assert bronze(spark, cfg) == [(1, 1.0, 2), (2, 2.0, 2)]
    assert spark.table(cfg.table(cfg.bronze_name)).inputFiles() == files


def test_only_new_files_are_taken_in(spark, cfg, land):
    land(1, 1.0)
    assert plans.build_bronze(spark, cfg, mode="append") == 1
    land(1, 1.5, mode="append")
    land(3, 3.0)
    assert plans.build_bronze(spark, cfg, mode="append") == 2
    assert bronze(spark, cfg) == [(1, 1.0, 2), (1, 1.5, 2), (3, 3.0, 2)]
    paths = {r[0].split("/")[-1] for r in spark.table(cfg.table(cfg.bronze_name)).select("source_file_path").distinct().collect()}
    assert paths == {"yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-03.parquet"}
    files = ingest.committed_files(spark, cfg.table(cfg.bronze_name))
    assert sorted((r.month, r.length > 0) for r in files.collect()) == [(1, True), (1, True), (3, True)]
    # A whole rebuild reads the zone as it is now, once.
    assert plans.build_bronze(spark, cfg) == 3
    assert bronze(spark, cfg) == [(1, 1.0, 2), (1, 1.5, 2), (3, 3.0, 2)]
    assert plans.build_bronze(spark, cfg, mode="append") == 0


@pytest.mark.parametrize("at", ["stage", "switch"])
def test_a_batch_that_was_broken_off_is_taken_up(spark, cfg, land, monkeypatch, at):
    land(1, 1.0)
    plans.build_bronze(spark, cfg, mode="append")
    land(2, 2.0)
    real = getattr(tables, at)
    with monkeypatch.context() as m:
        # The manifest's entries are written, the table's rows are not, or not yet committed.
        m.setattr(tables, at, lambda *a: real(*a) if any("_files" in str(x) for x in a) else broken())
        with pytest.raises(RuntimeError):
            plans.build_bronze(spark, cfg, mode="append")
    assert bronze(spark, cfg) == [(1, 1.0, 2)]
    assert [r.month for r in ingest.committed_files(spark, cfg.table(cfg.bronze_name)).collect()] == [1]
    land(3, 3.0)
    assert plans.build_bronze(spark, cfg, mode="append") == 2
    assert bronze(spark, cfg) == [(1, 1.0, 2), (2, 2.0, 2), (3, 3.0, 2)]


def test_a_file_that_was_written_anew_is_a_new_one(spark, cfg, land):
    land(1, 1.0)
    plans.build_bronze(spark, cfg, mode="append")
    land(1, 9.0, mode="overwrite")
    assert plans.build_bronze(spark, cfg, mode="append") == 1
    assert bronze(spark, cfg) == [(1, 1.0, 2), (1, 9.0, 2)]
    # Of repeats silver keeps the oldest.
    plans.build_silver(spark, cfg)
    assert {r.total_amount for r in spark.table(cfg.table(cfg.silver_name)).collect()} == {1.0}


def test_a_batch_with_an_unknown_column(spark, cfg, land):
    land(1, 1.0)
    plans.build_bronze(spark, cfg, mode="append")
    land(2, 2.0, novel=F.lit(1))
    with pytest.raises(SchemaDriftError, match="novel"):
        plans.build_bronze(spark, cfg, mode="append")
    assert bronze(spark, cfg) == [(1, 1.0, 2)]
    assert plans.build_bronze(spark, replace(cfg, unknown="drop"), mode="append") == 1
    assert bronze(spark, cfg) == [(1, 1.0, 2), (2, 2.0, 2)]


def test_nothing_landed_is_an_error_of_the_job(spark, cfg):
    with pytest.raises(NoLandedPeriodsError):
        plans.build_bronze(spark, cfg, mode="append")
