"""Repeated lines, found against levelled sorted runs of line hashes.

A store holds the hash of every line seen, with the document that had it first, as runs: tables
bucketed and sorted by hash, each a batch's new lines. A new batch is reduced to one row per hash,
merge-anti-joined with the runs, and what remains becomes a run of level 0. When a level holds
`fanout` runs they are merged into one of the next level, so a batch meets few runs and a hash is
rewritten a logarithmic number of times.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.scratch import Scratch
from faremill.llm.texts import LOWER, WHITE, slices, span_hashes, table

MIN_CHARS = 10
KEY = ["k1", "k2"]


def _line_keys(data: np.ndarray, starts: np.ndarray, min_chars: int) -> tuple[np.ndarray, ...]:
    """Of every line of every row: its row, begin and end in the data, two hashes of its key, and whether the key is long enough."""
    text = np.append(np.insert(data, starts[:-1], 10), np.uint8(10))
    breaks = np.flatnonzero(text == 10)
    row_breaks = starts + np.arange(len(starts))
    is_row = np.zeros(len(text), bool)
    is_row[row_breaks] = True
    begin, end = breaks[:-1] + 1, breaks[1:]
    row = np.cumsum(is_row[breaks[:-1]]) - 1
    solid = np.flatnonzero(~table(*WHITE)[text])
    a, b = np.searchsorted(solid, begin), np.searchsorted(solid, end)
    some = b > a
    low = begin.copy()
    high = begin.copy()
    low[some], high[some] = solid[a[some]], solid[b[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    long = points[high] - points[low] >= min_chars
    k1, k2 = np.zeros(len(begin), np.uint64), np.zeros(len(begin), np.uint64)
    lower = LOWER[text]
    k1[long], k2[long] = (span_hashes(lower, low[long], high[long], seed) for seed in (1, 2))
    return row, begin - row - 1, end - row - 1, k1.view(np.int64), k2.view(np.int64), long


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, k1, k2): each document's distinct line keys of at least `min_chars` code points. Rows without a doc_id have none."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, starts in slices(batch.column(1)):
                row, _, _, k1, k2, long = _line_keys(data, starts, min_chars)
                keys = np.unique(np.stack([row[long], k1[long], k2[long]]), axis=1) if long.any() else np.zeros((3, 0), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[first + keys[0]]), pa.array(keys[1]), pa.array(keys[2])], ["doc_id", "k1", "k2"])

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return named.mapInArrow(found, "doc_id long, k1 long, k2 long")


class LineRuns:
    """The runs of one store: tables `<name>_<level>_<id>` of the session's catalog."""

    def __init__(self, spark: SparkSession, name: str, buckets: int, fanout: int = 2):
        if buckets < 1 or fanout < 2:
            raise ValueError("a store needs a bucket and a fanout of 2 or more")
        self.spark, self.name, self.buckets, self.fanout = spark, name, buckets, fanout

    def runs(self) -> list[tuple[int, str]]:
        """Level and table of every run, low levels first."""
        found = [t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}_*")]
        return sorted((int(t.removeprefix(f"{self.name}_").split("_")[0]), t) for t in found)

    def _write(self, keys: DataFrame, level: int) -> str:
        made = f"{self.name}_{level}_{uuid.uuid4().hex[:12]}"
        dealt = keys.select(*KEY, "owner").repartition(self.buckets, *KEY)
        dealt.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(made)
        return made

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch of (doc_id, k1, k2) and returns the run of its new keys, each owned by the batch's smallest doc_id."""
        fresh = lines.groupBy(*KEY).agg(F.min("doc_id").alias("owner"))
        for _, run in self.runs():
            fresh = fresh.join(self.spark.table(run).select(*KEY), KEY, "left_anti")
        return self.spark.table(self._write(fresh, 0))

    def compact(self) -> None:
        """Merges every level that holds `fanout` runs into one run of the next."""
        level = 0
        while True:
            found = self.runs()
            here = [t for at, t in found if at == level]
            if len(here) >= self.fanout:
                merged = self.spark.table(here[0])
                for t in here[1:]:
                    merged = merged.unionByName(self.spark.table(t))
                self._write(merged, level + 1)
                for t in here:
                    self.spark.sql(f"DROP TABLE {t}")
            elif not any(at > level for at, _ in found):
                return
            level += 1

    def clear(self) -> None:
        for _, t in self.runs():
            self.spark.sql(f"DROP TABLE {t}")


def repeated_keys(docs: DataFrame, scratch: Scratch, batches: int = 4, min_chars: int = MIN_CHARS, rows_per_bucket: int = 2_000_000) -> DataFrame:
    """(doc_id, dropped): of each document that loses lines, the first halves of their hashes.

    The documents come as batches of rising doc_id, so the owner of a key is the smallest doc_id
    that holds it. A document's key is dropped unless the batch's own run names it as the owner.
    """
    spark = docs.sparkSession
    lines = scratch.keep(line_keys(docs, min_chars), "lines")
    count, edges = lines.agg(
        F.count("*"), F.percentile_approx("doc_id", [i / batches for i in range(1, batches)] or [0.5], 1000)
    ).first()
    cuts = sorted(set(edges or [])) if batches > 1 else []
    store = LineRuns(spark, f"lines_{uuid.uuid4().hex[:12]}", max(8, -(-count // rows_per_bucket)))
    lost = []
    try:
        for i in range(len(cuts) + 1):
            batch = lines
            if i:
                batch = batch.where(F.col("doc_id") > cuts[i - 1])
            if i < len(cuts):
                batch = batch.where(F.col("doc_id") <= cuts[i])
            own = store.add(batch).withColumnRenamed("owner", "doc_id")
            lost.append(scratch.keep(batch.join(own, ["doc_id", *KEY], "left_anti").select("doc_id", "k1"), f"lost-{i}"))
            store.compact()
    finally:
        store.clear()
    every = lost[0]
    for part in lost[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc_id").agg(F.collect_set("k1").alias("dropped"))


def _kept(texts: pa.Array, dropped: pa.Array, min_chars: int) -> Iterator[tuple[int, int, bytes]]:
    """Of each row: its lines, how many go, and the lines that stay."""
    for first, data, starts in slices(texts):
        row, begin, end, k1, _, long = _line_keys(data, starts, min_chars)
        bounds = np.searchsorted(row, np.arange(len(starts)))
        raw = data.tobytes()
        for r in range(len(starts) - 1):
            a, b = int(bounds[r]), int(bounds[r + 1])
            gone = dropped[first + r].as_py()
            if not gone:
                yield b - a, 0, raw[starts[r] : starts[r + 1]]
                continue
            out = long[a:b] & np.isin(k1[a:b], np.array(gone, np.int64))
            stay = [raw[x:y] for x, y in zip(begin[a:b][~out].tolist(), end[a:b][~out].tolist(), strict=True)]
            yield b - a, int(out.sum()), b"\n".join(stay)


def line_dedup_report(docs: DataFrame, batches: int = 4, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row.

    A NULL or empty text is one empty line. Rows without a doc_id keep all their lines and count
    for no other row. Rows that share a doc_id are one document: they don't take lines from each
    other. Columns other than doc_id and text are not read.
    """
    scratch = Scratch(docs.sparkSession)
    gone = repeated_keys(docs, scratch, batches, min_chars).withColumnRenamed("doc_id", "id")

    def report(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = [(n, lost, hashlib.sha256(text).hexdigest()) for n, lost, text in _kept(batch.column(1), batch.column(2), min_chars)]
            n, lost, digest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    joined = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(gone, F.col("doc_id") == F.col("id"), "left")
    return joined.select("doc_id", "text", "dropped").mapInArrow(report, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame, batches: int = 4, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents, all columns, without the lines that the report counts as dropped; a text that loses none stays as it is."""
    gone = repeated_keys(docs, Scratch(docs.sparkSession), batches, min_chars)
    names = {"id": "id", "gone": "gone"}
    for k in names:
        while names[k] in docs.columns:
            names[k] += "_"
    gone = gone.select(F.col("doc_id").alias(names["id"]), F.col("dropped").alias(names["gone"]))

    @F.pandas_udf("string")
    def shorter(texts, dropped):  # noqa: ANN001, ANN202
        import pandas as pd

        lists = pa.array([None if x is None else list(x) for x in dropped], pa.list_(pa.int64()))
        return pd.Series([t.decode() for _, _, t in _kept(pa.array(texts, pa.string()), lists, min_chars)])

    joined = docs.join(gone, docs["doc_id"] == gone[names["id"]], "left")
    text = F.when(F.col(names["gone"]).isNull(), F.col("text")).otherwise(shorter("text", names["gone"]))
    return joined.withColumn("text", text).select(*docs.columns)
