"""The registered queries and the pipeline on the smallest tables, against SQL or a plain version."""

from __future__ import annotations

import base64
import collections

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from faremill.llm import decontam
from faremill.llm.oracles import ORACLES
from faremill.llm.queries import QUERIES

from .test_operators import plain_components, plain_lines

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_entry_has_the_operators_and_the_pipeline():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and {*QUERIES, "pipeline"} <= {*names}
    assert {*ORACLES} <= {*__spark_entry__.oracle_sql()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = tables.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in got.select(columns).collect()) == sorted(want)


def test_token_rollups_equal_a_recount(spark, tables):
    rows = tables.execute("SELECT doc_id, text, source, lang FROM documents ORDER BY doc_id").fetchall()
    encoders = {}
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(f"{name}.tiktoken"), "rb"))}
        encoders[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want, seen = collections.defaultdict(lambda: [0, 0]), set()
    for _, text, source, lang in rows:
        if text in seen:
            continue
        seen.add(text)
        version = "byte_bpe_50k" if lang == "en" else "byte_bpe_multi_50k"
        want[source, lang, version][0] += 1
        want[source, lang, version][1] += len(encoders[version].encode_ordinary(text))
    got = QUERIES["op8_token_rollups"](spark, SF_DIR).collect()
    assert {(r.source, r.lang, r.version): [r.documents, r.tokens] for r in got} == dict(want)


def test_token_rollups_hold_rows_without_an_id(spark, tmp_path):
    rows = [(1, "one two", "s", "en"), (None, "one two", "s", "en"), (None, "un deux", "s", "fr"), (None, "tres", "t", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.source, r.lang, r.version): r.documents for r in QUERIES["op8_token_rollups"](spark, str(tmp_path)).collect()}
    assert got == {("s", "en", "byte_bpe_50k"): 2, ("s", "fr", "byte_bpe_multi_50k"): 1, ("t", None, "byte_bpe_multi_50k"): 1}


def test_languages_on_held_out_documents(spark, tables):
    truth = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = [r for r in QUERIES["op4_centroid_langid"](spark, SF_DIR).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.97 * len(got)


def test_stages_do_their_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = docs.collect(), stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
        rows = [(r.doc_id, r.text) for r in before]
        if name == "line_dedup":
            want = {i: "\n".join(kept) for i, (kept, _) in plain_lines(rows).items()}
            assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {i: (t, len(t)) for i, t in want.items()}
        if name == "near_duplicates":
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in plain_components(rows, 5).items() if c == i}
        if name == "decontamination":
            hits = decontam.leaks(spark.createDataFrame(before), spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
            gone = {r.doc_id for r in hits.collect()}
            assert gone and {r.doc_id for r in docs.collect()} == {i for i, _ in rows} - gone
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
