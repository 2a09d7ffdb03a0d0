"""Quality of documents by ordinal regression on graded ratings.

A document has a grade of 0 (toxic), 1 (poor) or 2 (good). The model is a cumulative-link one: P(grade <= k) is the
logistic function of threshold k minus the document's score, the thresholds are ordered, and the score is a sum of weights of hashed
text features, shared by all grades. From it follow the expected grade and the tail
probability that a selection is made by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.notices import BREAKS
from faremill.llm.texts import BASE, mix, slices, span_hashes, table, words

BITS = 18
#: A token counts once, and once more at each of these numbers of occurrences.
STEPS = (1, 4, 16)
SYMBOLS = tuple(b for b in range(256) if b <= 32 or 48 <= b <= 57 or 97 <= b <= 122 or b >= 127)


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature and rising thresholds between the grades."""

    weights: np.ndarray
    thresholds: np.ndarray


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (row, feature) pairs: each row's words, runs of symbols, and repeats of a word after itself, by how often they occur."""
    rows, codes = [], []
    for separators, salt in ((table(*BREAKS), 0), (table(*SYMBOLS), 1)):
        text, begin, end, first = words(data, starts, separators)
        hashes = mix(span_hashes(text, begin, end) + np.uint64(salt))
        row = np.repeat(np.arange(len(starts) - 1), np.diff(first))
        rows.append(row)
        codes.append(hashes)
        if not salt:
            again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) if len(hashes) else np.zeros(0, int)
            rows.append(row[again])
            codes.append(np.full(len(again), BASE, np.uint64))
    row, code = np.concatenate(rows), np.concatenate(codes)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(row)))
    row, code = row[at], code[at]
    out_row, out_code = [], []
    for step in STEPS:
        big = count >= step
        out_row.append(row[big])
        out_code.append(mix(code[big] + np.uint64(step * 2**32)) >> np.uint64(64 - BITS))
    row, code = np.concatenate(out_row), np.concatenate(out_code).astype(np.int64)
    order = np.argsort(row, kind="stable")
    return row[order], code[order]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(row: np.ndarray, code: np.ndarray, grade: np.ndarray, grades: int, sparse: float = 1e-3, turns: int = 250) -> OrdinalModel:
    """Weights and ordered thresholds by proximal steps of adaptive size; the penalty on absolute weights leaves most at zero.

    Grades count equally, however many documents have them.
    """
    n, size = len(grade), 1 << BITS
    used, code = np.unique(code, return_inverse=True)
    share = np.bincount(grade, minlength=grades)
    weight = 1 / (np.maximum(share, 1)[grade] * max(1, (share > 0).sum()))
    w, cuts = np.zeros(len(used)), np.linspace(-1, 1, grades - 1)
    gains, cut_gains = np.full(len(used), 1e-8), np.full(grades - 1, 1e-8)
    for _ in range(turns):
        score = np.bincount(row, weights=w[code], minlength=n)
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        high, low = _sigmoid(edge[grade + 1] - score), _sigmoid(edge[grade] - score)
        # The slope of -log P(grade) by the score is 1 - high - low.
        g = np.bincount(code, weights=(weight * (1 - high - low))[row], minlength=len(used))
        prob = np.maximum(high - low, 1e-9)
        cut_g = np.array([(weight * ((grade == k + 1) * low * (1 - low) - (grade == k) * high * (1 - high)) / prob).sum() for k in range(grades - 1)])
        gains += g * g
        cut_gains += cut_g * cut_g
        step = 0.3 / np.sqrt(gains)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
        cuts = np.sort(cuts - 0.3 / np.sqrt(cut_gains) * cut_g)
    weights = np.zeros(size, np.float32)
    weights[used] = w
    return OrdinalModel(weights, cuts)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labelled documents: 0 if toxic, else 1 or 2 by quality. A document with several labels has its lowest
    grade; without an id or with both labels NULL there is none."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, max_rated: int = 6000, sparse: float = 1e-3, turns: int = 250) -> OrdinalModel:
    """A model of the rated documents: at most `max_rated` of them, those with the smallest hash of their doc_id. Fewer ratings want a higher penalty `sparse`."""
    picked = ratings.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rated).collect()
    sample = docs.sparkSession.createDataFrame([(r["doc_id"], r["grade"]) for r in picked], "own_id long, grade int")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, starts in slices(batch.column(1)):
                row, code = features(data, starts)
                edges = np.searchsorted(row, np.arange(len(starts)))
                own = [code[a:b].astype("<u4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                part = batch.slice(first, len(own))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(own, pa.binary())], ["doc_id", "grade", "codes"])

    # The sample's size is bounded by its parameter.
    rated = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), F.col("doc_id") == F.col("own_id"))
    rated = rated.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").alias("grade")).select("doc_id", "text", "grade")
    got = rated.mapInArrow(made, "doc_id long, grade int, codes binary").toArrow().sort_by("doc_id")
    codes = [np.frombuffer(c, "<u4") for c in got["codes"].to_pylist()]
    if not codes:
        return OrdinalModel(np.zeros(1 << BITS, np.float32), np.linspace(-1, 1, grades - 1))
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    return fit_ordinal(row, np.concatenate(codes).astype(np.int64), got["grade"].to_numpy().astype(int), grades, sparse, turns)


def grade_documents(docs: DataFrame, model: OrdinalModel, at_least: int = 2, probability: float = 0.3) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept) of every row: kept where P(grade >= at_least) reaches `probability`.

    A NULL text is an empty one. Columns other than doc_id and text are not read.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, starts in slices(batch.column(1)):
                row, code = features(data, starts)
                score = np.bincount(row, weights=model.weights[code], minlength=len(starts) - 1)
                above = 1 - _sigmoid(model.thresholds[None, :] - score[:, None])
                tail = above[:, at_least - 1]
                columns = [batch.column(0).slice(first, len(score)), pa.array(above.sum(axis=1)), pa.array(tail), pa.array(tail >= probability)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", "tail_probability", "kept"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return asked.mapInArrow(told, "doc_id long, expected_grade double, tail_probability double, kept boolean")
