"""Partitions of a catalog table switched to new files.

Rows are written below a new folder that the table doesn't know. Only when all of them are there is each partition pointed at its new folder, which
is one catalog change. A write that ends half way leaves the table as it was, and the next one clears its files away. The files
that a partition had until now stay until the write after this one, so queries that are running can finish.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.text import sql_text

#: Formats that are folders of files, where this library does the switch; others have commits of their own.
FILE_FORMATS = frozenset({"parquet", "orc", "avro", "json", "csv", "text"})
_STAGE = "_stage-"


def _path(spark: SparkSession, text: str) -> tuple[JavaObject, JavaObject]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _folders(spark: SparkSession, text: str) -> list[str]:
    """The folders below a path."""
    path, fs = _path(spark, text)
    return [str(s.getPath().toString()) for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []


def _leaves(spark: SparkSession, text: str, depth: int) -> list[str]:
    found = [text]
    for _ in range(depth):
        found = [f for parent in found for f in _folders(spark, parent)]
    return found


def _described(spark: SparkSession, table: str, spec: str = "") -> str:
    """The location of a table, or of its partition."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _spec(name: str) -> str:
    """A partition as SQL names it, from the name of its folder."""
    values = (part.split("=", 1) for part in name.split("/"))
    return ", ".join(f"{c} = {'NULL' if v == '__HIVE_DEFAULT_PARTITION__' else sql_text(unquote(v))}" for c, v in values)


def partition_names(spark: SparkSession, table: str) -> list[str]:
    """The table's partitions as their folders are named, such as year=2023/month=1."""
    return [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _locations(spark: SparkSession, table: str) -> dict[str, str]:
    names = partition_names(spark, table)
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip(names, pool.map(lambda n: _described(spark, table, f"PARTITION ({_spec(n)})"), names), strict=True))


def _same(a: str, b: str) -> bool:
    bare = lambda text: text.split(":", 1)[-1].lstrip("/").rstrip("/")
    return bare(a) == bare(b)


def stage(df: DataFrame, table: str, by: Sequence[str], provider: str | None, one: Mapping[str, str] | None = None) -> str:
    """Writes the rows below a new folder of the table, by partition, and returns the folder. The table doesn't change.

    A partitioned write sorts every task's rows by partition, and spills where they outgrow its memory. Rows that are all of the partition `one` names, by
    column, need no sort: they go straight into its folder, which isn't there without rows, as in the other case.
    """
    spark = df.sparkSession
    folder = f"{_described(spark, table)}/{_STAGE}{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if one is None else df.drop(*by).write
    writer = writer.format(provider) if provider else writer
    if one is None:
        writer.save(folder)
        return folder
    if any(not re.fullmatch(r"[A-Za-z0-9-]+", value) for value in one.values()):
        raise ValueError(f"values that a folder can't be named by as they are: {one}")
    leaf = "/".join([folder, *(f"{c}={one[c]}" for c in by)])
    writer.save(leaf)
    reader = spark.read.schema(df.drop(*by).schema)
    if (reader.format(provider) if provider else reader).load(leaf).isEmpty():
        path, fs = _path(spark, leaf)
        fs.delete(path, True)
    return folder


def switch(spark: SparkSession, table: str, by: Sequence[str], folder: str, gone: Column | None) -> None:
    """Points the partitions that the folder has rows for at it.

    Other partitions are dropped where `gone`, a condition on the partition columns, holds. Each partition is switched by itself: a reader sees each
    either as it was or as it is. Files go last, and only those that no partition had when the switch began.
    """
    before = _locations(spark, table)
    depth = len(by)
    written = {"/".join(leaf.rstrip("/").split("/")[-depth:]): leaf for leaf in _leaves(spark, folder, depth)}
    for name, leaf in written.items():
        spec = f"PARTITION ({_spec(name)})"
        if name in before:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {sql_text(leaf)}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {sql_text(leaf)}")
    left = [n for n in before if n not in written]
    if gone is not None and left:
        types = {f.name: f.dataType for f in spark.table(table).schema.fields}
        rows = spark.createDataFrame([(n, *(unquote(p.split("=", 1)[1]) for p in n.split("/"))) for n in left], ["_name", *by])
        typed = rows.select("_name", *[F.when(F.col(c) != "__HIVE_DEFAULT_PARTITION__", F.col(c)).cast(types[c]).alias(c) for c in by])
        for row in typed.where(gone).collect():
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(row['_name'])})")
    spark.catalog.refreshTable(table)
    _clear(spark, table, depth, [*before.values(), *written.values()])


def _clear(spark: SparkSession, table: str, depth: int, kept: Sequence[str]) -> None:
    """Removes staged partitions other than those kept, and folders that are empty then."""
    for folder in _folders(spark, _described(spark, table)):
        if not folder.rstrip("/").rpartition("/")[2].startswith(_STAGE):
            continue
        leaves = _leaves(spark, folder, depth)
        stale = [leaf for leaf in leaves if not any(_same(leaf, k) for k in kept)]
        for text in [folder] if len(stale) == len(leaves) else stale:
            path, fs = _path(spark, text)
            fs.delete(path, True)
