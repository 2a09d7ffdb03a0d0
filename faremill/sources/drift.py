"""Schema-drift report: which columns change type, appear or disappear between landed periods."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faremill.contracts import ABSENT_TYPE, TableContract
from faremill.sources.landing import SOURCE_COL, LandedPeriod, LandingZone, landed_schemas, lossy, read_landed, with_period_path


def drift_table(spark: SparkSession, schemas: Mapping[LandedPeriod, StructType]) -> DataFrame:
    """Column by period table of type names, from file footers alone.

    `n_types` counts the distinct entries of a row, an absence being one of them;
    `drifts` marks rows with more than one. Names that differ only in case are different rows.
    """
    kinds = {p.kind for p in schemas}
    keys = {p: p.key if len(kinds) == 1 else f"{p.kind}_{p.key}" for p in schemas}
    entries = spark.createDataFrame(
        [(f.name, keys[p], f.dataType.simpleString()) for p, s in schemas.items() for f in s.fields],
        "column_name string, period string, type_name string",
    )
    periods = [keys[p] for p in sorted(schemas)]
    wide = entries.groupBy("column_name").pivot("period", periods).agg(F.first("type_name"))
    typed = wide.select("column_name", *[F.coalesce(F.col(p), F.lit(ABSENT_TYPE)).alias(p) for p in periods])
    n_types = F.size(F.array_distinct(F.array(*periods)))
    return typed.withColumn("n_types", n_types).withColumn("drifts", F.col("n_types") > 1)


def drift_impact(
    spark: SparkSession, schemas: Mapping[LandedPeriod, StructType], contract: TableContract
) -> DataFrame:
    """Per column that drifts: values present, and how many of them the contract cast changes in type.

    One pass per landed period. Columns that land everywhere with one type are not read.
    """
    landed = Counter((f.name, f.dataType.simpleString()) for s in schemas.values() for f in s.fields)
    steady = [name for (name, _), n in landed.items() if n == len(schemas)]
    parts = [spark.createDataFrame([], "column_name string, present long, retyped long")]
    for _, df in read_landed(spark, schemas):
        df = df.drop(*[c for c in df.columns if c in steady])
        if not df.columns:
            continue
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        retyped = []
        for f in df.schema.fields:
            spec = contract.find(f.name)
            if spec is not None and spec.data_type != f.dataType:
                retyped.append(f.name)
        parts.append(
            counts.unpivot([], df.columns, "column_name", "present").withColumn(
                "retyped", F.when(F.col("column_name").isin(*retyped), F.col("present")).otherwise(F.lit(0))
            )
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("column_name")
        .agg(F.sum("present").alias("values_present"), F.sum("retyped").alias("values_retyped"))
    )


def schema_drift(spark: SparkSession, zone: LandingZone, contract: TableContract) -> DataFrame:
    """The drift table with the number of values each drift touches, NULL where nothing drifts.

    `in_contract` is false for columns the contract doesn't know, which bronze passes through.
    """
    schemas = landed_schemas(spark, zone)
    known = [c.name.lower() for c in contract.landed()]
    report = drift_table(spark, schemas).join(drift_impact(spark, schemas, contract), "column_name", "left")
    return report.withColumn("in_contract", F.lower("column_name").isin(*known))


def cast_losses(spark: SparkSession, zone: LandingZone, contract: TableContract) -> DataFrame:
    """What the cast to the contract does to values, by column and period: (column_name, kind, period, landed_type, values_present, values_lost, values_cut).

    One row for each period and column that landed as a fraction's type where the contract wants an integer. `values_lost` are those that become NULL (NaN,
    infinities, numbers out of range), `values_cut` those that stay but lose their fraction; NULLs are neither, nor are they present. Periods without rows have
    no row here. Columns that can't lose anything are not read, and each schema of the zone is one scan with one map-side aggregate.
    """
    schemas = landed_schemas(spark, zone)
    parts = [spark.createDataFrame([], f"{SOURCE_COL} string, column_name string, landed_type string, values_present long, values_lost long, values_cut long")]
    for periods, df in read_landed(spark, schemas):
        specs = {f.name: contract.find(f.name) for f in df.schema.fields}
        risky = [f for f in df.schema.fields if specs[f.name] is not None and lossy(f.dataType, specs[f.name].data_type)]
        if not risky:
            continue
        counters = []
        for f in risky:
            value = F.col(f"`{f.name}`")
            kept = value.try_cast(specs[f.name].data_type)
            counters.append(
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("landed_type"),
                    F.count(value).alias("values_present"),
                    F.count_if(value.isNotNull() & kept.isNull()).alias("values_lost"),
                    F.count_if(kept.cast(f.dataType) != value).alias("values_cut"),
                )
            )
        read = with_period_path(df.select(*[f"`{f.name}`" for f in risky]), periods)
        parts.append(read.groupBy(SOURCE_COL).agg(F.array(*counters).alias("counters")).select(SOURCE_COL, F.inline("counters")))
    named = spark.createDataFrame([(p.path, p.kind, p.key) for p in schemas], f"{SOURCE_COL} string, kind string, period string")
    counted = reduce(DataFrame.unionByName, parts).join(named, SOURCE_COL)
    return counted.select("column_name", "kind", "period", "landed_type", "values_present", "values_lost", "values_cut")
