"""Landed files taken into a table once each, by a manifest.

A batch is what a run finds new: files that no committed batch has, by path, length and modification time. Its number is a hash of
these, so the same files make the same batch. The manifest is written first and its entries count only once the table
has the batch's partition, which is the commit: a run that ends before leaves neither rows nor entries that count, and the next
takes the same files again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.contracts import ColumnSpec, TableContract
from faremill.sinks.staging import partition_names
from faremill.sinks.tables import write_table
from faremill.sources.landing import LandedPeriod, LandingZone, landed_schemas

BATCH = "ingest_batch"
_FILE = "path string, length long, modified timestamp, kind string, year int, month int"
_COMMENT = "Files taken into the table, by batch; a batch counts once the table has its partition"


@dataclass(frozen=True, order=True)
class LandedFile:
    """A file as the landing zone has it, and the period it landed for."""

    path: str
    length: int
    modified: datetime
    period: LandedPeriod

    @property
    def identity(self) -> tuple[str, int, datetime]:
        return self.path, self.length, self.modified


def landed_files(spark: SparkSession, zone: LandingZone) -> list[LandedFile]:
    """Every file of every landed period, as Spark's reader lists them; no content is read."""
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    periods = {}
    for period in zone.expected():
        path = jvm.org.apache.hadoop.fs.Path(period.path)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            periods[fs.makeQualified(path).toString()] = period
    if not periods:
        return []
    # Several at once, since a listing of many paths is one of Spark's jobs.
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([p.path for p in periods.values()])
    found = []
    for row in listing.select("path", "length", "modificationTime").collect():
        owner = row["path"]
        while owner not in periods:
            owner = owner.rpartition("/")[0]
        found.append(LandedFile(row["path"], row["length"], row["modificationTime"], periods[owner]))
    return sorted(found)


def batch_number(files: Sequence[LandedFile]) -> str:
    text = "\n".join(f"{path}|{length}|{modified.isoformat()}" for path, length, modified in sorted(f.identity for f in files))
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def manifest_name(table: str) -> str:
    return f"{table}_files"


def committed_files(spark: SparkSession, table: str) -> DataFrame:
    """The manifest's entries of the batches that the table has."""
    manifest = manifest_name(table)
    if not (spark.catalog.tableExists(table) and spark.catalog.tableExists(manifest)):
        return spark.createDataFrame([], f"{_FILE}, {BATCH} string")
    batches = [name.split("=", 1)[1] for name in partition_names(spark, table) if name.startswith(f"{BATCH}=")]
    return spark.table(manifest).where(F.col(BATCH).isin(batches))


def new_periods(spark: SparkSession, table: str, files: Sequence[LandedFile]) -> tuple[list[LandedPeriod], list[LandedFile]]:
    """The files that no committed batch has, and their periods, each with only these to read."""
    landed = spark.createDataFrame([f.identity for f in files], "path string, length long, modified timestamp")
    fresh = {r["path"] for r in landed.join(committed_files(spark, table), ["path", "length", "modified"], "left_anti").collect()}
    new = [f for f in files if f.path in fresh]
    by_period: dict[LandedPeriod, list[str]] = {}
    for f in new:
        by_period.setdefault(f.period, []).append(f.path)
    whole = {p: sum(f.period == p for f in files) for p in by_period}
    # A period that is new as a whole is read by its path, so that the folders below it keep their meaning.
    return [p if len(paths) == whole[p] else replace(p, only=tuple(paths)) for p, paths in by_period.items()], new


def write_manifest(spark: SparkSession, table: str, files: Sequence[LandedFile], batch: str) -> None:
    rows = [(*f.identity, f.period.kind, f.period.year, f.period.month, batch) for f in files]
    entries = spark.createDataFrame(rows, f"{_FILE}, {BATCH} string")
    columns = tuple(ColumnSpec(f.name, f.dataType, "") for f in entries.schema.fields)
    write_table(entries, manifest_name(table), TableContract(columns), _COMMENT, partition_by=(BATCH,), replace_partitions=True)


__all__ = ["BATCH", "LandedFile", "batch_number", "committed_files", "landed_files", "landed_schemas", "manifest_name", "new_periods", "write_manifest"]
