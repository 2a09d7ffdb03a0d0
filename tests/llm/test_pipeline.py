"""The whole pipeline against plain stages, and on tables that are empty or hold NULLs, repeated ids and clashing columns."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from faremill.llm import decontam, langid

from .test_operators import plain_components, plain_lines

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    accepted = {r.doc_id for r in langid.language_report(docs).collect() if r.accepted}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in accepted]
    rows = [(i, "\n".join(kept)) for i, (kept, _) in plain_lines(rows).items()]
    first = {i for i, (_, c) in plain_components(rows, 5).items() if c == i}
    rows = [(i, t) for i, t in rows if i in first]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    leaking = {r.doc_id for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*encode.encode(t, add_special_tokens=False).ids, 0] for i, t in rows if i not in leaking}
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    assert leaking and pieces.keys() == ids.keys()
    for found, total in [(sorted(p), len(ids[i])) for i, p in pieces.items()] + [(sorted(p), None) for p in places.values()]:
        ends = [0, *np.cumsum([n for _, n in found]).tolist()]
        assert [at for at, _ in found] == ends[:-1] and ends[-1] == (total or ends[-1]) and (total or ends[-1] <= 1024)


def test_run_on_odd_tables(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long, k1 long, hub string, cell int, owner long, rejected_id long"
    text = "some words that are long enough to be a line of their own"
    rows = [(1, text, "en"), (2, None, None), (3, "", "en"), (3, text, "fr"), (3, text, "fr"), (None, text, "en"), (None, None, None), (4, "x", "en")]
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, some in (("odd", rows), ("empty", [])):
        docs = spark.createDataFrame([(*r, "s", 1, 1, "h", 1, 1, 1) for r in some], shape)
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in got} <= {1, 2, 3, 4, None}
        if not some:
            assert not got
        else:
            assert 1 in {r.doc_id for r in got}
