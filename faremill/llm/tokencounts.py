"""Token totals by source, language and tokenizer version, maintained by deltas.

A store holds, for every committed batch, its signed entries (a document's tokens with +1, or what it had before
with -1) and their sums by group. Totals are the sum of all committed sums. Entries are sorted by document, and a commit reads the
range of ids that its batch touches; `compact` merges what was committed into net entries and one table of sums, so that the store
grows with the documents that it counts and not with its history. A batch is looked up against the net
entries of its documents only: an insert adds, a delete takes back what is there, a
revised count does both. Its files lie in a folder of their own and count once its commit marker is written,
so a batch that is sent again, or was broken off, changes nothing twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.packing import plain_encoder

GROUP = ["source", "lang", "version"]
ENTRY = "doc_id long, source string, lang string, version string, sign int, tokens long"
SUMS = "source string, lang string, version string, documents long, tokens long"
CHANGE = "op string, doc_id long, source string, lang string, version string, tokens long"


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, source, lang, tokens): every row's number of tokens under a rank file of the tiktoken library; of a NULL text 0."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encode = plain_encoder(ranks, pattern)
        for batch in batches:
            n = [len(encode(t.as_py() or "")) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64())], ["doc_id", "source", "lang", "tokens"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return asked.mapInArrow(counted, "doc_id long, source string, lang string, tokens long")


class TokenLedger:
    """A store below `path`, which driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, name: str):  # noqa: ANN202
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _marked(self, name: str) -> list[str]:
        files, path = self._files(name)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _mark(self, name: str) -> None:
        files, path = self._files(name)
        files.create(path, False).close()

    def committed(self) -> list[str]:
        """Names of the batches that count."""
        return self._marked("commits")

    def _merged(self, generation: str) -> set[str]:
        """The batches in a compaction. Their names are metadata: one for each commit."""
        return {r.batch for r in self.spark.read.schema("batch string").parquet(f"{self.path}/merged/{generation}/batches").collect()}

    def _read(self, kind: str, schema: str) -> DataFrame:
        """What counts now: the last compaction, and the batches committed since."""
        last = self._marked("compactions")[-1:]
        inside = self._merged(last[0]) if last else set()
        paths = [f"{self.path}/merged/{g}/{kind}" for g in last] + [f"{self.path}/{kind}/{b}" for b in self.committed() if b not in inside]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _net(self) -> DataFrame:
        entries = self._read("entries", ENTRY)
        return entries.groupBy("doc_id", *GROUP, "tokens").agg(F.sum("sign").cast("int").alias("sign")).where("sign > 0")

    def compact(self) -> None:
        """Merges all that is committed into net entries, in files by ranges of doc_id, and one table of sums.

        The merged tables count once their marker is written; a compaction that was broken off is overwritten by the next. Batches stay
        committed, so one that is sent again still changes nothing. Files that the compaction before this one replaced are removed;
        those that this one replaces stay, for queries that are running.
        """
        done = self._marked("compactions")
        before = self._merged(done[-1]) if done else set()
        generation, batches = f"{len(done):08d}", self.committed()
        folder = f"{self.path}/merged/{generation}"
        net = self._net().select(*[c.split()[0] for c in ENTRY.split(", ")])
        net.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").parquet(f"{folder}/entries")
        self.totals().write.mode("overwrite").parquet(f"{folder}/sums")
        self.spark.createDataFrame([(b,) for b in batches], "batch string").write.mode("overwrite").parquet(f"{folder}/batches")
        self._mark(f"compactions/{generation}")
        for name in [f"merged/{g}" for g in done[:-1]] + [f"{kind}/{b}" for kind in ("entries", "sums") for b in before]:
            files, path = self._files(name)
            files.delete(path, True)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies (op, doc_id, source, lang, version, tokens); false, and nothing done, if the batch has been committed.

        op is `insert`, `delete` or `revise`; other rows are refused. A document is counted once for each version: an insert of one that
        is there acts as a revision, a revision of one that isn't as an insert, and a delete takes back the entry of
        its version (of all versions, if its version is NULL). Of several changes to a document and version in one batch a delete comes last, and of counts the
        highest. Rows without a doc_id are refused.
        """
        if not batch or "/" in batch:
            raise ValueError("a batch needs a name without slashes")
        if batch in self.committed():
            return False
        bad = changes.where("op IS NULL OR op NOT IN ('insert', 'delete', 'revise') OR doc_id IS NULL").limit(1).count()
        if bad:
            raise ValueError("changes need a doc_id and one of the operations insert, delete and revise")
        names = [c.split()[0] for c in CHANGE.split(", ")]
        changes = changes.select(*names)
        last = changes.groupBy("doc_id", "version").agg(F.max(F.struct((F.col("op") == "delete").alias("gone"), "tokens", "source", "lang")).alias("c"))
        last = last.select("doc_id", "version", "c.*")
        # Documents taken in since have other ids as a rule: the range keeps the scan off most of the store's row groups.
        least, most = changes.agg(F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first()
        entries = self._read("entries", ENTRY).where(F.col("doc_id").between(least, most))
        net = entries.join(changes.select("doc_id").distinct(), "doc_id", "left_semi")
        net = net.groupBy("doc_id", *GROUP, "tokens").agg(F.sum("sign").alias("n")).where("n > 0").select("doc_id", *GROUP, "tokens")
        touched = last.select(F.col("doc_id").alias("id"), F.col("version").alias("v"), "gone")
        back = net.join(touched, (F.col("doc_id") == F.col("id")) & (F.col("version").eqNullSafe(F.col("v")) | (F.col("v").isNull() & F.col("gone"))), "left_semi")
        signed = back.withColumn("sign", F.lit(-1)).unionByName(
            last.where("NOT gone").select("doc_id", *GROUP, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.lit(1).alias("sign"))
        )
        columns = [c.split()[0] for c in ENTRY.split(", ")]
        signed.select(*columns).sortWithinPartitions("doc_id").write.mode("overwrite").parquet(f"{self.path}/entries/{batch}")
        entries = self.spark.read.schema(ENTRY).parquet(f"{self.path}/entries/{batch}")
        sums = entries.groupBy(*GROUP).agg(F.sum(F.col("sign").cast("long")).alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/sums/{batch}")
        self._mark(f"commits/{batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, documents, tokens) of the groups that have documents."""
        sums = self._read("sums", SUMS).groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0")
