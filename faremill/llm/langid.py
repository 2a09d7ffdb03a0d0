"""Language of a text by the nearest of several centroids per language.

A text's vector holds the square roots of its counts of letter 1- to 3-grams, hashed, weighted by
inverse document frequency and brought to length 1. Each language's training vectors are clustered
by cosine into a few centroids, so that registers of one language needn't share a mean. A
text gets the language of the nearest centroid, and is rejected when it is farther from it than
a bound drawn from the distances that texts of its length have to centroids learned without them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.texts import BASE

BINS = 4096
UNKNOWN = "und"
#: Characters of a text counted at once; longer ones are cut at the next blank.
PIECE = 400_000
#: Hashes of ids lie below this.
HASHES = 1 << 40
#: Held-out texts that a quantile is taken of at least, where there are so many.
HELD_OUT = 30
CLASSES = 16
#: Texts of smaller classes, of fewer than 31 grams, are too short to tell a stranger; those of the class FULL, of 1023 grams, tell as well as any.
TELLING, FULL = 5, 10
#: Rows of a batch taken out of it at once.
ROWS = 256


@dataclass(frozen=True)
class LanguageModel:
    """Sorted languages, the centroids with their language's number, the weights, and the least cosine accepted by power of two of the grams."""

    languages: tuple[str, ...]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(65536)])


def gram_counts(texts: list[str], bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed letter 1- to 3-grams by text, and whether the text has a letter. Other characters are spaces."""
    out, has = np.zeros((len(texts), bins), np.float32), np.zeros(len(texts), bool)
    short = [i for i, t in enumerate(texts) if len(t) <= PIECE]
    out[short], has[short] = _counts([texts[i] for i in short], bins)
    for i, text in enumerate(texts):
        low = 0
        while len(text) > PIECE and low < len(text):
            blank = re.compile(r"\s").search(text, low + PIECE, low + 2 * PIECE)
            high = blank.start() if blank else low + PIECE
            counts, letter = _counts([text[low:high]], bins)
            out[i] += counts[0]
            has[i] |= letter[0]
            low = high
    return out, has


def _counts(texts: list[str], bins: int) -> tuple[np.ndarray, np.ndarray]:
    letter, lower = _letters(), [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(lower)), [len(t) + 1 for t in lower])[: len(points)]
    solid = letter[np.minimum(points, 65535)] | (points > 65535)
    has = np.bincount(row[solid], minlength=len(texts)) > 0
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    points = np.where(solid, points, 32)[keep].astype(np.uint64)
    row, out = row[keep], np.zeros(len(texts) * bins, np.float32)
    code = np.zeros(len(points), np.uint64)
    for n in (1, 2, 3):
        if len(points) < n:
            break
        code = (code[: len(points) - n + 1] + points[n - 1 :] + np.uint64(n)) * np.uint64(BASE)
        code ^= code >> np.uint64(29)
        same = row[: len(code)] == row[n - 1 :]
        at = row[: len(code)] * bins + ((code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.int64) % bins
        out += np.bincount(at[same], minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), bins), has


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def clusters(rows: np.ndarray, k: int, turns: int = 10, least_share: float = 0.02) -> np.ndarray:
    """Up to k unit centroids by spherical k-means, from seeds that are each farthest from those before.

    Such seeds seek out odd texts, so a centroid that holds less than `least_share` of the rows is given up and the others are centred anew.
    """
    chosen = [0]
    while len(chosen) < min(k, len(rows)):
        near = (rows @ rows[chosen].T).max(axis=1)
        if near.min() > 1 - 1e-6:
            break
        chosen.append(int(near.argmin()))
    centres = rows[chosen]
    for turn in range(2 * turns):
        own = (rows @ centres.T).argmax(axis=1)
        held = np.bincount(own, minlength=len(centres))
        if turn == turns:
            large = held >= least_share * len(rows)
            # Rows of a centroid that goes count for none, or they would draw another one to themselves.
            rows, own, centres = rows[large[own]], (np.cumsum(large) - 1)[own[large[own]]], centres[large]
            held = held[large]
        centres = unit(np.stack([rows[own == c].sum(axis=0) if held[c] else centres[c] for c in range(len(centres))]))
    return centres


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.sqrt(counts) * idf)


def size_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + counts.sum(axis=1)).astype(int), CLASSES - 1)


def least_cosines(scaled: np.ndarray, own: np.ndarray, sizes: np.ndarray, centroids: int, slack: float, quantile: float, folds: int = 3) -> np.ndarray:
    """By size class, `slack` times a low quantile of the cosines of texts to centroids of their language that were learned without them.

    A class takes in its neighbours until it has HELD_OUT such texts, and its bound is no more than that of all texts together, so that a few odd ones of any size
    lower it for all. Below the class FULL the bound falls in proportion to the class, since a few names or numbers outweigh the words of a short text; below TELLING
    it is 0.
    """
    fold, near = np.zeros(len(scaled), int), np.full(len(scaled), np.nan)
    for language in np.unique(own):
        fold[own == language] = np.arange((own == language).sum()) % folds
        for f in range(folds):
            learned, held = (own == language) & (fold != f), (own == language) & (fold == f)
            if learned.any() and held.any():
                near[held] = (scaled[held] @ clusters(scaled[learned], centroids).T).max(axis=1)
    known, least = ~np.isnan(near), np.zeros(CLASSES)
    if not known.any():
        return least
    near, sizes = near[known], sizes[known]
    first, most = int(sizes.min()), np.quantile(near, quantile)
    for c in range(TELLING, CLASSES):
        at, wide = max(c, first), 0
        while (some := np.abs(sizes - at) <= wide).sum() < min(HELD_OUT, len(near)):
            wide += 1
        least[c] = slack * min(most, np.quantile(near[some], quantile)) * min(1.0, c / FULL)
    return least


def _sample(rows: DataFrame, per_language: int, max_languages: int) -> list[tuple[str, int]]:
    """(lang, doc_id) of the `per_language` documents of each language with the smallest hashes of their ids.

    How many documents a language has says below which hash so many are to be expected; only those are gathered, a few hundred for each language.
    """
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # Six standard deviations more than wanted, so that too few are found once in many billions.
    wanted = per_language + 6 * per_language**0.5 + 20
    bounds = [(r["lang"], HASHES if r["n"] <= 2 * wanted else int(HASHES * wanted / r["n"]) + 1) for r in sizes]
    below = rows.sparkSession.createDataFrame(bounds, "own_lang string, below long")
    hashed = rows.select("lang", F.col("doc_id").cast("long").alias("doc_id")).withColumn("hash", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)))
    few = hashed.join(F.broadcast(below), F.col("lang") == F.col("own_lang")).where("hash < below").select("lang", "hash", "doc_id").distinct().collect()
    found: dict[str, list[tuple[int, int]]] = {}
    for r in few:
        found.setdefault(r["lang"], []).append((r["hash"], r["doc_id"]))
    return [(lang, doc) for lang, docs in found.items() for _, doc in sorted(docs)[:per_language]]


def fit(
    docs: DataFrame, learn: Column, per_language: int = 300, centroids: int = 4, max_languages: int = 500, slack: float = 0.8, quantile: float = 0.01
) -> LanguageModel:
    """A model of the rows where `learn` holds and lang is not NULL.

    It is fitted on a sample: of every language the `per_language` documents with the smallest hash of their
    doc_id. A text is accepted down to `slack` times the cosine that the share `quantile` of held-out texts of its size class stays below.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    picked = _sample(rows, per_language, max_languages)
    if not picked:
        return LanguageModel((), np.zeros(0, int), np.zeros((0, BINS), np.float32), np.ones(BINS, np.float32), np.zeros(CLASSES))
    sample = docs.sparkSession.createDataFrame(sorted(picked), "own_lang string, own_id long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                counts, has = gram_counts([t or "" for t in part.column("text").to_pylist()])
                found = pa.array([c.tobytes() for c in counts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("lang"), found], ["lang", "counts"]).filter(pa.array(has))

    # The sample's size is bounded by its parameters. A repeated doc_id counts once.
    text = F.col("text").cast("string")
    joined = rows.select("lang", F.col("doc_id").cast("long"), text.alias("text"))
    joined = joined.join(F.broadcast(sample), (F.col("doc_id") == F.col("own_id")) & (F.col("lang") == F.col("own_lang")))
    joined = joined.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text")
    got = joined.mapInArrow(counted, "lang string, counts binary").toArrow().sort_by([("lang", "ascending"), ("counts", "ascending")])
    names = got["lang"].to_pylist()
    counts = np.frombuffer(b"".join(got["counts"].to_pylist()), np.float32).reshape(-1, BINS)
    languages = tuple(sorted(set(names)))
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    scaled, own = vectors(counts, idf), np.array([languages.index(n) for n in names])
    centres = [clusters(scaled[own == i], centroids) for i in range(len(languages))]
    least = least_cosines(scaled, own, size_class(counts), centroids, slack, quantile)
    owner = np.repeat(np.arange(len(languages)), [len(c) for c in centres])
    return LanguageModel(languages, owner, np.concatenate(centres).astype(np.float32), idf, least)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row.

    score is the cosine to the nearest centroid; of equal ones the first language in order wins. A NULL text, or
    one without letters, is `und` with score 0 and rejected; so is every text under a model that has
    learned no language. Only doc_id and text are read.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                low, size = 0, 0
                texts = [t or "" for t in some.column(1).to_pylist()]
                for i, t in enumerate(texts):
                    size += len(t)
                    if size > PIECE or i - low == 63 or i == len(texts) - 1:
                        yield from part(some.slice(low, i + 1 - low), texts[low : i + 1])
                        low, size = i + 1, 0

    def part(batch: pa.RecordBatch, texts: list[str]) -> Iterator[pa.RecordBatch]:
        counts, has = gram_counts(texts)
        has &= len(model.languages) > 0
        score, best = np.zeros(len(texts)), np.zeros(len(texts), int)
        if has.any():
            cosines = vectors(counts[has], model.idf) @ model.centroids.T
            best[has], score[has] = cosines.argmax(axis=1), np.clip(cosines.max(axis=1), 0, 1)
        accepted = has & (score >= model.least[size_class(counts)])
        names = [model.languages[model.owner[b]] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
        columns = [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(accepted)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "accepted"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return asked.mapInArrow(told, "doc_id long, lang_pred string, score double, accepted boolean")


def fold(parts: int = 4) -> Column:
    """A row's fold: the crc32 of its doc_id as text, modulo the number of folds."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def language_report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted): a model learned outside fold 2, applied to every row."""
    model = fit(docs, fold() != 2)
    return predict(docs, model).select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """The documents, all columns, whose text is near a language of the corpus; a row without a doc_id stays."""
    name = "rejected_id"
    while name in docs.columns:
        name += "_"
    lost = language_report(docs).where("NOT accepted").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(lost, docs["doc_id"] == lost[name], "left_anti")
