"""The registered queries: each operator with its production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import alignment, decontam, knn, langid, lexical, linedup, neardup, notices, packing, pseudonyms, quality, tokencounts, urls
from faremill.llm.scratch import Scratch


def _table(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return decontam.leaks(read("documents"), read("benchmark"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    return quality.grade_documents(docs, quality.fit(docs, quality.graded(read("labels"))))


def op8_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits: all documents counted by one tokenizer; the same batch sent again; the texts that aren't
    English counted by a second tokenizer version in place of the first; exact copies of a smaller doc_id deleted. Before the last one the store is compacted.

    Rows without a doc_id can't be in a ledger, which is kept by doc_id. Each is a document of its own, a copy of none, and is added
    to the totals under the version that holds for its language."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, nameless = table.where("doc_id IS NOT NULL"), table.where("doc_id IS NULL")
    scratch = Scratch(spark)
    ledger = tokencounts.TokenLedger(spark, f"{scratch.root}/ledger")
    count = lambda rows, name: tokencounts.count_tokens(rows, public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN)
    as_change = lambda rows, op, version: rows.withColumns({"op": F.lit(op), "version": F.lit(version)})
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    every = as_change(scratch.keep(count(docs, first), "counted"), "insert", first)
    ledger.commit("0001-load", every)
    ledger.commit("0001-load", every)
    foreign = docs.where("lang IS DISTINCT FROM 'en'")
    recounted = as_change(scratch.keep(count(foreign, second), "recounted"), "insert", second)
    ledger.commit("0002-upgrade", recounted.unionByName(as_change(foreign.select("doc_id", "source", "lang", F.lit(0).cast("long").alias("tokens")), "delete", first)))
    ledger.compact()
    prints = docs.select("doc_id", F.xxhash64("text").alias("a"), F.md5("text").alias("b"))
    least = prints.groupBy("a", "b").agg(F.min("doc_id").alias("first_id"))
    copies = prints.join(least, ["a", "b"]).where("doc_id > first_id").select("doc_id").distinct()
    gone = copies.select("doc_id", *(F.lit(None).cast("string").alias(c) for c in ("source", "lang", "version")), F.lit(0).cast("long").alias("tokens"))
    ledger.commit("0003-copies", gone.withColumn("op", F.lit("delete")))
    parts = [(nameless.where("lang = 'en'"), first), (nameless.where("lang IS DISTINCT FROM 'en'"), second)]
    out = ledger.totals()
    for rows, version in parts:
        more = count(rows, version).withColumn("version", F.lit(version)).groupBy(*tokencounts.GROUP)
        out = out.unionByName(more.agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens")))
    return out.groupBy(*tokencounts.GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


def op11_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return lexical.top_documents(read("documents"), read("benchmark"), k=10)


def op12_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words are counted in all documents; the pages' own URLs are what naive Bayes learns from."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    pages = read("pages")
    return urls.judge(pages, urls.fit(pages, read("documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nnls_packing": _table("documents", lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json"))),
    # The key of a deployment comes from its secret store; this one makes the query repeatable.
    "op2_feistel_pseudonyms": _table("documents", lambda d: pseudonyms.pseudonymize(d, key="a key for the test tables")),
    "op3_tensored_minhash": _table("documents", lambda d: neardup.near_duplicates(d, words=2, percent=80)),
    "op4_centroid_langid": _table("documents", langid.language_report),
    "op5_voronoi_knn": _table("embeddings", lambda d: knn.top_k(d, F.col("vec_id") % 100 == 0, k=10)),
    "op6_ordinal_quality": op6_ordinal_quality,
    "op7_fuzzy_notices": _table("documents", notices.notice_report),
    "op8_token_rollups": op8_token_rollups,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_runs": _table("documents", linedup.line_dedup_report),
    "op11_length_strata": op11_length_strata,
    "op12_host_words": op12_host_words,
    "op13_galloping_alignment": _table("documents", lambda d: alignment.align_documents(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))),
}
