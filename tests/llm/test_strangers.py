"""Languages that no centroid was learned of, sampling without a hot task, and texts of any length."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from faremill.llm import langid
from faremill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
FINNISH = (
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan "
    "kohtaan veljeyden hengessä suomen kieli kuuluu uralilaisten kielten kuntaan ja sitä puhutaan pääasiassa suomessa talo seisoo mäellä ja lapset leikkivät pihalla"
).split()


def strangers():
    """Texts in no language of the tables; some are said to be English, and may be learned from as such."""
    rng = random.Random(3)
    gibberish = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))
    texts = [" ".join(rng.choice(FINNISH) for _ in range(n)) for n in (50, 300)] + [gibberish(n) for n in (50, 300)] + ["漢字仮名交じり文" * 40]
    return [(10**6 + i, t, "en" if i % 2 else None, "src0", len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def with_strangers(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs.unionByName(spark.createDataFrame(strangers(), docs.schema)).cache()


def test_strangers_are_rejected_and_nothing_else(spark, with_strangers):
    got = {r.doc_id: r for r in langid.language_report(with_strangers).collect()}
    assert {i for i, r in got.items() if not r.accepted} == {i for i, *_ in strangers()}


def test_the_language_stage_drops_strangers(spark, with_strangers):
    kept = corpus_pipeline.language(spark, with_strangers, SF_DIR)
    assert kept.columns == with_strangers.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in with_strangers.select("doc_id").collect()} - {i for i, *_ in strangers()}


def test_the_sample_is_the_smallest_hashes(spark):
    rows = [(i, "en" if i % 3 else "fr", "x") for i in range(9000)] + [(5, "en", "x")] * 50 + [(i, "de", "y") for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {}
    for lang, doc in langid._sample(df, 40, 500):
        got.setdefault(lang, set()).add(doc)
    hashed = df.selectExpr("lang", "doc_id", f"pmod(xxhash64(doc_id), {langid.HASHES}) AS h").distinct().collect()
    assert got == {x: {r.doc_id for r in sorted((r for r in hashed if r.lang == x), key=lambda r: (r.h, r.doc_id))[:40]} for x in ("en", "fr", "de")}
    with pytest.raises(ValueError, match="languages"):
        langid._sample(df, 40, 2)


def test_long_texts_are_counted_whole(monkeypatch):
    words = " ".join(random.Random(1).choices(["ala", "Bela", "çé", "x"], k=4000))
    whole, has = langid.gram_counts([words, "12", ""])
    monkeypatch.setattr(langid, "PIECE", 100)
    parts, has_parts = langid.gram_counts([words, "12", ""])
    assert (has == has_parts).all() and has.tolist() == [True, False, False]
    # A cut at a blank loses the grams across it and the blank itself.
    assert np.abs(whole - parts).sum() <= 6 * len(words) / 100 and (whole[1:] == 0).all()
    counts, _ = langid.gram_counts(["a" * 1000])
    assert counts.sum() >= 3 * 1000 - 40


def test_bounds_fall_with_the_size_class():
    rng = np.random.default_rng(1)
    scaled = langid.unit(np.abs(rng.normal(size=(90, 20)))).astype(np.float32)
    least = langid.least_cosines(scaled, np.arange(90) % 3, np.full(90, 8), 2, 0.7, 0.01)
    assert (least[:5] == 0).all() and (np.diff(least[4:11]) > 0).all() and (least[10:] == least[10]).all() and 0 < least[10] < 0.8
    assert (langid.least_cosines(scaled[:1], np.zeros(1, int), np.full(1, 8), 2, 0.7, 0.01) == 0).all()


def test_query_accepts_every_document_of_the_tables(spark):
    assert all(r.accepted for r in QUERIES["op4_centroid_langid"](spark, SF_DIR).collect())
