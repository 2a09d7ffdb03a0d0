"""Benchmark items in training texts, edited copies included.

All of an item's 3-word grams are its seeds, however common or rare they are. Where a document holds a seed, the words
around it, as many as an alignment of the least score can span, are counted; if enough of them are words of the
item, they are aligned with it by Smith-Waterman, and the score is the share of the best that the item could
reach. Counting leaves out only what no alignment could bring to the least score.

The benchmark is taken in blocks of bounded size; each is one scan of the documents and no
shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.notices import BREAKS
from faremill.llm.texts import BASE, grams, mix, slices, span_hashes, table, words

GRAM = 3
#: Bytes of benchmark text held by every task at once.
BLOCK_BYTES = 8_000_000
#: Pairs of a seed and a place, or words around places, worked on at once.
CELLS = 2_000_000
LEAST_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1


def align(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local score of each item (rows, padded with 0) in its window (rows, padded with 1), and where that ends in both."""
    rows, width = windows.shape
    steps = np.arange(width + 1, dtype=np.int32) * -GAP
    before = np.zeros((rows, width + 1), np.int32)
    best, item_end, window_end = np.zeros(rows, np.int32), np.zeros(rows, int), np.zeros(rows, int)
    for i in range(items.shape[1]):
        same = np.where(items[:, i : i + 1] == windows, MATCH, MISMATCH)
        now = np.zeros_like(before)
        now[:, 1:] = np.maximum(0, np.maximum(before[:, :-1] + same, before[:, 1:] + GAP))
        now = np.maximum.accumulate(now + steps, axis=1) - steps
        at = now.argmax(axis=1)
        top = now[np.arange(rows), at]
        better = top > best
        best[better], item_end[better], window_end[better] = top[better], i + 1, at[better]
        before = now
    return best, item_end, window_end


def _item_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all items one after another, and where each begins."""
    column = pa.array(texts, pa.large_string())
    parts, bounds = [np.zeros(0, np.uint64)], [0]
    for _, data, starts in slices(column):
        text, begin, end, first = words(data, starts, table(*BREAKS))
        parts.append(span_hashes(text, begin, end))
        bounds += (bounds[-1] + first[1:]).tolist()
    return np.concatenate(parts), np.array(bounds)


class Items:
    """A block of the benchmark: items with words, and the grams of each."""

    def __init__(self, rows: list[tuple[int, str]], gram: int):
        hashes, bounds = _item_words([t for _, t in rows])
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.words = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        # An item of fewer words is one gram; it must then stand as a whole.
        self.sizes = np.array([min(gram, len(w)) for w in self.words], int)
        own = [grams(w, n) if n else w for w, n in zip(self.words, self.sizes, strict=True)]
        self.owner = np.repeat(np.arange(len(own)), [len(g) for g in own])
        self.place = np.concatenate([np.arange(len(g)) for g in own]) if own else np.zeros(0, int)
        self.grams = np.concatenate(own) if own else np.zeros(0, np.uint64)
        self.lengths = sorted({int(n) for n in self.sizes if n})


def _hits(hashes: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where a row holds one of the sorted grams: row, word in the row, number of the gram."""
    own = grams(hashes, n)
    if not len(own) or not len(wanted):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    marks = np.zeros(1 << 18, bool)
    marks[wanted >> np.uint64(46)] = True
    at = np.flatnonzero(marks[own >> np.uint64(46)])
    number = np.minimum(np.searchsorted(wanted, own[at]), len(wanted) - 1)
    ok = wanted[number] == own[at]
    at, number = at[ok], number[ok]
    row = np.searchsorted(bounds, at, "right") - 1
    ok = at + n <= bounds[row + 1]
    return row[ok], (at - bounds[row])[ok], number[ok]


def _document_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    breaks = table(*BREAKS)
    for first, data, starts in slices(column):
        text, begin, end, bounds = words(data, starts, breaks)
        yield first, span_hashes(text, begin, end), bounds


def _pair_keys(hashes: np.ndarray, item: np.ndarray) -> np.ndarray:
    """A hash of a word together with an item's number."""
    return mix(hashes + (item.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))


def _parts(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of the rows, whose sizes add up to CELLS at most, or of one row."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CELLS, "right")))
        yield slice(low, high)
        low = high


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from low on, as many as size says, of one row after another."""
    return np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())


def _aligned(docs: DataFrame, items: Items, least: float) -> DataFrame:
    by_length = {}
    for n in items.lengths:
        own = np.flatnonzero(items.sizes[items.owner] == n)
        own = own[np.argsort(items.grams[own], kind="stable")]
        by_length[n] = (items.grams[own], items.owner[own], items.place[own])
    lengths = np.array([len(w) for w in items.words], int)
    # A score of `least` leaves room for so many words of the document beside those that match.
    reach = np.floor(MATCH * lengths * (1 - least) / -GAP + 1e-9).astype(int)
    step = lengths // 4 + 1
    held = np.unique(_pair_keys(np.concatenate([*items.words, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(lengths)), lengths)))
    item_words, ids = items.words, items.ids

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0)
            for first, hashes, bounds in _document_words(batch.column(1)):
                tried = candidates(hashes, bounds)
                best: dict[tuple[int, int], tuple[float, int, int, int, int]] = {}
                for low in range(0, len(tried), 512):
                    for row, item, *rest in scored(tried[low : low + 512], hashes, bounds):
                        if (row, item) not in best or (-rest[0], rest[1]) < (-best[row, item][0], best[row, item][1]):
                            best[row, item] = tuple(rest)
                rows = sorted(best)
                columns = [names.take(pa.array([first + r for r, _ in rows], pa.int64())), pa.array([int(ids[i]) for _, i in rows], pa.int64())]
                values = list(zip(*(best[r] for r in rows), strict=True)) or [()] * 5
                columns += [pa.array(values[0], pa.float64()), *(pa.array(v, pa.int64()) for v in values[1:])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "first_word", "n_words", "item_first_word", "item_words"])

    def candidates(hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, low, high): stretches of words to align, one for seeds that lie nearly as they do in the item."""
        found = []
        for n, (wanted, owner, place) in by_length.items():
            own = np.unique(wanted)
            row, word, number = _hits(hashes, bounds, own, n)
            low = np.searchsorted(wanted, own[number], "left")
            times = np.searchsorted(wanted, own[number], "right") - low
            for part in _parts(times):
                at = _ranges(low[part], times[part])
                item, start = owner[at], np.repeat(word[part], times[part]) - place[at]
                found.append(np.unique(np.stack([np.repeat(row[part], times[part]), item, start // step[item]]), axis=1))
        if not found:
            return []
        row, item, nth = np.unique(np.concatenate(found, axis=1), axis=1)
        low = np.maximum(0, nth * step[item] - reach[item])
        high = np.minimum(bounds[row + 1] - bounds[row], (nth + 1) * step[item] + lengths[item] + reach[item])
        keep = np.zeros(len(row), bool)
        for part in _parts(high - low):
            size = (high - low)[part]
            key = _pair_keys(hashes[_ranges((bounds[row] + low)[part], size)], np.repeat(item[part], size))
            own = held[np.minimum(np.searchsorted(held, key), len(held) - 1)] == key
            # Every match is a word of the item: with fewer than its share of them the score is below `least`.
            keep[part] = np.add.reduceat(own.astype(int), np.cumsum(size) - size) >= least * lengths[item[part]] - 1e-9
        out = zip(*(x[keep].tolist() for x in (row, item, low, high)), strict=True)
        return sorted(out, key=lambda c: len(item_words[c[1]]))

    def scored(tried: list[tuple[int, int, int, int]], hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
        deep, wide = max(len(item_words[i]) for _, i, _, _ in tried), max(h - s for _, _, s, h in tried)
        if len(tried) > 1 and len(tried) * wide > 4_000_000:
            yield from scored(tried[: len(tried) // 2], hashes, bounds)
            yield from scored(tried[len(tried) // 2 :], hashes, bounds)
            return
        a, b = np.zeros((len(tried), deep), np.uint64), np.ones((len(tried), wide), np.uint64)
        for k, (r, i, s, h) in enumerate(tried):
            a[k, : len(item_words[i])] = item_words[i]
            b[k, : h - s] = hashes[bounds[r] + s : bounds[r] + h]
        best, item_end, end = align(a, b)
        good = np.flatnonzero(best >= least * MATCH * np.array([len(item_words[i]) for _, i, _, _ in tried]))
        if not len(good):
            return
        # Backwards from where the best alignment ends, it ends where that one begins.
        back_a, back_b = np.zeros_like(a[good]), np.ones_like(b[good])
        for k, g in enumerate(good.tolist()):
            back_a[k, : item_end[g]] = a[g, : item_end[g]][::-1]
            back_b[k, : end[g]] = b[g, : end[g]][::-1]
        _, item_size, size = align(back_a, back_b)
        for k, g in enumerate(good.tolist()):
            r, i, s, _ = tried[g]
            score = float(best[g]) / (MATCH * len(item_words[i]))
            yield r, i, score, int(s + end[g] - size[k]), int(size[k]), int(item_end[g] - item_size[k]), int(item_size[k])

    schema = "doc_id long, item_id long, score double, first_word long, n_words long, item_first_word long, item_words long"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, score, first_word, n_words, item_first_word, item_words): where a document holds an item or an edited copy.

    One row for each document and item, of the place with the highest score (the first of equal ones), if that is `least` or
    more; score is the alignment's share of the item's best, 1 for an exact copy up to case and punctuation. A place is seen by
    `gram` words of the item that stand there one after another; edits that leave no such run, as every third word replaced, hide
    it. Words are counted from 0. Rows of either table that have a NULL id or text, and items without words, find nothing; repeated
    rows are reported each. Other columns than ids and texts are not read.
    """
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    out = None
    for b in range(max(1, blocks)):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))) == b).distinct().collect()
        block = Items(sorted((r["item_id"], r["text"]) for r in rows), gram)
        found = _aligned(texts, block, least)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents, all columns, that hold no benchmark item; a row without a doc_id stays."""
    name = "leaking_id"
    while name in docs.columns:
        name += "_"
    lost = leaks(docs, benchmark, least).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(lost, docs["doc_id"] == lost[name], "left_anti")
