"""Catalog tables: writing, describing and reading them back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.contracts import TableContract
from faremill.errors import SchemaDriftError
from faremill.functions.text import sql_text
from faremill.sinks.staging import FILE_FORMATS, stage, switch


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema if it isn't there; `location` puts its tables below a folder of choice."""
    where = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def comment_on_table(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {sql_text(comment)}")


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """`df` with the table's columns and types in the table's order; columns it lacks are NULL.

    A column the table lacks is an error by name: appending would have to drop its values.
    """
    fields = df.sparkSession.table(table).schema.fields
    known, have = {f.name.lower() for f in fields}, {c.lower() for c in df.columns}
    new = [c for c in df.columns if c.lower() not in known]
    if new:
        raise SchemaDriftError(f"table {table} has no columns {new}")
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def write_table(
    df: DataFrame,
    table: str,
    contract: TableContract,
    comment: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    provider: str | None = None,
    rebalance: bool = False,
    replace_partitions: bool = False,
    emptied: Column | None = None,
    one: Mapping[str, str] | None = None,
) -> None:
    """Save `df` as a managed table with table and column descriptions.

    Column comments travel as field metadata, because a partition column can't be altered
    after the fact. `rebalance` asks AQE for files of the advisory size: rows are shuffled by
    the partition columns, and a partition too big for one task is split over several.
    `provider` is the table format; unset, Spark's default, which must be one of files.

    A partitioned table of files is overwritten by staging: new files are written beside the old ones and partitions switched to them
    once all are there (see `faremill.sinks.staging`), so a write that fails leaves the table readable as it was.
    `replace_partitions` leaves alone the partitions that `df` has no rows for, but for those under `emptied`, a condition on the
    partition columns, which are dropped. `one` names the partition by column where all rows are of one, which saves a sort. A table without partitions, or whose columns or types change, is overwritten by
    Spark, which is not atomic.
    """
    spark = df.sparkSession
    out = contract.describe(df)
    if rebalance and partition_by:
        out = out.hint("rebalance", *partition_by)
    exists = spark.catalog.tableExists(table)
    staged = bool(partition_by) and mode == "overwrite" and (provider or "parquet").lower() in FILE_FORMATS
    if staged and (not exists or not replace_partitions and not _same_columns(spark, table, out)):
        # An empty table first, so that a broken-off write leaves one that can be written again.
        _create(out.limit(0), table, "overwrite", partition_by, provider)
    if staged:
        folder = stage(_aligned(out, table), table, partition_by, provider, one)
        switch(spark, table, partition_by, folder, emptied if replace_partitions else F.lit(True))
    elif exists and replace_partitions:
        _aligned(out, table).writeTo(table).overwritePartitions()
    elif exists and mode == "append":
        _aligned(out, table).write.insertInto(table)
    else:
        _create(out, table, mode, partition_by, provider)
    comment_on_table(spark, table, comment)


def _create(df: DataFrame, table: str, mode: str, partition_by: Sequence[str], provider: str | None) -> None:
    writer = df.write.mode(mode)
    if provider:
        writer = writer.format(provider)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def _same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    """Whether a table has just the frame's columns and types, with the same descriptions."""
    shape = lambda schema: sorted((f.name.lower(), f.dataType.simpleString(), f.metadata.get("comment") or "") for f in schema.fields)
    return shape(spark.table(table).schema) == shape(df.schema)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def column_dictionary(spark: SparkSession, table: str) -> DataFrame:
    """Position, name, type and description of a table's columns, as the catalog holds them."""
    fields = spark.table(table).schema.fields
    return spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.metadata.get("comment")) for i, f in enumerate(fields, 1)],
        "position int, column_name string, type_name string, comment string",
    )
