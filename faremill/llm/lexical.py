"""Ranked lexical search over an index stratified by length.

The score of a document depends on its length only through a whole number m, so documents of equal m form a stratum, and
within it all postings of a term with equal tf have one impact. The index holds strata in units of bounded size: for each term its
postings by tf, and its largest tf. From these follows a bound that no document of the unit exceeds for an item. The
strata's bounds order the visits: the best ones are scored first, their k-th best score is the threshold for the next, and
what stays below it is never read into scores. Impacts are computed once for each term, unit and tf.

Items are taken in blocks of bounded size, each against the whole index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.notices import BREAKS
from faremill.llm.scratch import Scratch
from faremill.llm.texts import slices, span_hashes, table, words

#: Documents of a stratum that one share of its rows takes in the shuffle, on average.
SHARE_DOCS = 4096
#: Postings and documents of a unit.
UNIT_POSTINGS, UNIT_DOCS = 1 << 20, 1 << 15
#: Bytes of items' terms held by every task at once.
ITEM_BYTES = 4_000_000
#: Postings or sums worked on at once.
CELLS = 2_000_000
#: Shares of the documents that the first rounds of visits cover; the last round takes what the threshold leaves.
ROUNDS = (1 / 256, 1 / 16)
#: Whole numbers that doubles hold exactly.
EXACT = 2.0**53

UNIT = (
    "m long, docs long, doc_ids binary, terms binary, dfs binary, tops binary, term_groups binary, tfs binary, group_places binary, places binary"
)


@dataclass(frozen=True)
class LexicalIndex:
    """The units of an index, its number of documents with a term, and of all their terms."""

    units: DataFrame
    documents: int
    terms: int


def _term_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, hashes of all terms of some rows, and where each row's begin."""
    breaks = table(*BREAKS)
    for first, data, starts in slices(column):
        text, begin, end, bounds = words(data, starts, breaks)
        yield first, span_hashes(text, begin, end), bounds


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from low on, as many as size says, of one row after another."""
    return np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    breaks = table(*BREAKS)
    for batch in batches:
        for _, data, starts in slices(batch.column(0)):
            bounds = words(data, starts, breaks)[3]
            n, docs = np.unique(np.diff(bounds), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["n", "docs"])


def _terms_of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, tfs): the distinct terms of each document that has one, sorted, and how often it holds them."""
    for batch in batches:
        ids = batch.column(0)
        for first, hashes, bounds in _term_hashes(batch.column(1)):
            at, n, terms, tfs = [], [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                if a == b:
                    continue
                own, times = np.unique(hashes[a:b], return_counts=True)
                at.append(first + i)
                n.append(b - a)
                terms.append(own.tobytes())
                tfs.append(times.astype(np.uint32).tobytes())
            columns = [ids.take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])


def _unit(m: int, ids: list[int], terms: list[np.ndarray], tfs: list[np.ndarray]) -> list:
    """A unit's row: its postings by term, tf and document."""
    sizes = [len(t) for t in terms]
    term, tf, place = np.concatenate(terms), np.concatenate(tfs), np.repeat(np.arange(len(ids)), sizes)
    order = np.lexsort((place, tf, term))
    term, tf, place = term[order], tf[order], place[order]
    new_term = np.append(True, term[1:] != term[:-1])
    new_group = new_term | np.append(True, tf[1:] != tf[:-1])
    groups = np.flatnonzero(new_group)
    starts = np.flatnonzero(new_term)
    term_groups = np.append(np.searchsorted(groups, starts), len(groups)).astype(np.uint32)
    ends = np.append(starts[1:], len(term))
    return [
        m, len(ids), np.array(ids, np.int64).tobytes(), term[starts].tobytes(), (ends - starts).astype(np.uint32).tobytes(), tf[ends - 1].tobytes(),
        term_groups.tobytes(), tf[groups].tobytes(), np.append(groups, len(term)).astype(np.uint32).tobytes(), place.astype(np.uint16).tobytes(),
    ]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents sorted by m and share become units."""
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 8]
    names = [c.split()[0] for c in UNIT.split(", ")]
    key, ids, terms, tfs, held = None, [], [], [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(_unit(key[0], ids, terms, tfs), types, strict=True)], names)

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)
        for m, share, doc, own, times in rows:
            if ids and ((m, share) != key or held >= UNIT_POSTINGS or len(ids) >= UNIT_DOCS):
                yield made()
                ids, terms, tfs, held = [], [], [], 0
            key = (m, share)
            ids.append(doc)
            terms.append(np.frombuffer(own, np.uint64))
            tfs.append(np.frombuffer(times, np.uint32))
            held += len(terms[-1])
    if ids:
        yield made()


def build_index(docs: DataFrame, scratch: Scratch, name: str = "index") -> LexicalIndex:
    """The index of all documents that have an id and a term, written below the scratch folder.

    A document of n terms has m = 10 + (90 * n * N) div L, N being the number of indexed documents and L that of all their terms.
    Terms are compared by hashes of 64 bits. Rows that repeat an id are documents of their own. Strata of more than
    SHARE_DOCS documents are dealt out by the hash of the id. If s strata have so many, their documents' m add up to SHARE_DOCS * s * s / 2 at least, and to 100 * N
    at most, so there are no more than sqrt(200 * N / SHARE_DOCS) of them; the list of these is all that is broadcast.
    """
    asked = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    lengths = scratch.keep(asked.select("text").mapInArrow(_lengths, "n long, docs long").where("n > 0").groupBy("n").agg(F.sum("docs").alias("docs")), f"{name}-lengths")
    total = lengths.agg(F.sum("docs"), F.sum(F.col("n").cast("decimal(38,0)") * F.col("docs"))).first()
    documents, terms = int(total[0] or 0), int(total[1] or 0)
    m = F.expr(f"10L + (CAST(n AS DECIMAL(18,0)) * {90 * documents}BD) div {max(1, terms)}BD")
    strata = lengths.groupBy(m.alias("large_m")).agg(F.sum("docs").alias("docs")).where(F.col("docs") > SHARE_DOCS)
    large = docs.sparkSession.createDataFrame(strata.select("large_m", F.ceil(F.col("docs") / SHARE_DOCS).cast("long")).collect(), "large_m long, shares long")
    held = asked.mapInArrow(_terms_of_documents, "doc_id long, n long, terms binary, tfs binary").withColumn("m", m)
    held = held.join(F.broadcast(large), F.col("m") == F.col("large_m"), "left")
    share = F.pmod(F.xxhash64("doc_id"), F.coalesce("shares", F.lit(1)))
    rows = held.select("m", share.alias("share"), "doc_id", "terms", "tfs")
    units = rows.repartition("m", "share").sortWithinPartitions("m", "share", "doc_id").mapInArrow(_units, UNIT)
    return LexicalIndex(scratch.keep(units, name), documents, terms)


class _Asked:
    """A block of items: their distinct terms, and which item has which."""

    def __init__(self, rows: list[tuple[int, int]]):
        items, hashes = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64).view(np.uint64)
        self.ids, self.item = np.unique(items, return_inverse=True)
        self.terms, self.term = np.unique(hashes, return_inverse=True)
        order = np.lexsort((self.term, self.item))
        self.item, self.term = self.item[order], self.term[order]
        self.weights = np.zeros(len(self.terms), np.int64)

    def weigh(self, found: dict[int, int], documents: int) -> None:
        for t, df in found.items():
            self.weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def within(self, terms: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Which of the asked terms a unit has, and where it has them."""
        own = np.frombuffer(terms, np.uint64)
        at = np.minimum(np.searchsorted(own, self.terms), len(own) - 1)
        have = np.flatnonzero(own[at] == self.terms)
        return have, at[have]


def _impacts(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _sums(group: np.ndarray, values: np.ndarray, size: int, most: float) -> np.ndarray:
    """Sums of whole numbers by group, exact: in doubles where `most`, their bound, allows it."""
    if most < EXACT:
        return np.bincount(group, weights=values, minlength=size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, group, values)
    return out


def _most(asked: _Asked) -> float:
    """No score of an item exceeds this."""
    return float(np.bincount(asked.item, weights=asked.weights[asked.term], minlength=1).max(initial=0)) * 1_000_000


def _unit_bounds(asked: _Asked, have: np.ndarray, at: np.ndarray, tops: bytes, m: int, most: float) -> np.ndarray:
    value = np.zeros(len(asked.terms), np.int64)
    value[have] = asked.weights[have] * _impacts(np.frombuffer(tops, np.uint32)[at], m)
    return _sums(asked.item, value[asked.term], len(asked.ids), most)


def _frequencies(index: LexicalIndex, asked: _Asked) -> dict[int, int]:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(asked.terms), np.int64)
        for batch in batches:
            for terms, dfs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                have, at = asked.within(terms)
                sums[have] += np.frombuffer(dfs, np.uint32)[at]
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some])], ["t", "df"])

    found = index.units.select("terms", "dfs").mapInArrow(counted, "t long, df long").groupBy("t").agg(F.sum("df").alias("df"))
    return {r["t"]: r["df"] for r in found.collect()}


def _stratum_bounds(index: LexicalIndex, asked: _Asked) -> DataFrame:
    """(item, m, bound, docs): for each item and stratum the most that a document can score, where that is over 0."""
    most = _most(asked)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m, docs, terms, tops in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                bound = _unit_bounds(asked, *asked.within(terms), tops, m, most)
                item = np.flatnonzero(bound)
                columns = [pa.array(item, pa.int64()), pa.array(np.full(len(item), m)), pa.array(bound[item]), pa.array(np.full(len(item), docs))]
                yield pa.RecordBatch.from_arrays(columns, ["item", "m", "bound", "docs"])

    found = index.units.select("m", "docs", "terms", "tops").mapInArrow(bounded, "item long, m long, bound long, docs long")
    return found.groupBy("item", "m").agg(F.max("bound").alias("bound"), F.sum("docs").alias("docs"))


def _visit(index: LexicalIndex, asked: _Asked, low: np.ndarray, high: np.ndarray, threshold: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each unit whose bound for the item lies in [low, high), of scores from the item's threshold on."""
    most = _most(asked)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                unit = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                have, at = asked.within(unit["terms"])
                bound = _unit_bounds(asked, have, at, unit["tops"], unit["m"], most)
                chosen = np.flatnonzero((bound > 0) & (bound >= low) & (bound < high))
                if len(chosen):
                    yield from scored(unit, have, at, chosen)

    def scored(unit: dict, have: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, size = np.frombuffer(unit["doc_ids"], np.int64), unit["docs"]
        term_groups = np.frombuffer(unit["term_groups"], np.uint32).astype(np.int64)
        group_places = np.frombuffer(unit["group_places"], np.uint32).astype(np.int64)
        tfs, places = np.frombuffer(unit["tfs"], np.uint32), np.frombuffer(unit["places"], np.uint16)
        # Of each asked term its groups, then one impact for each group, and the places of all of them.
        n_groups = term_groups[at + 1] - term_groups[at]
        group = _ranges(term_groups[at], n_groups)
        impact = np.repeat(asked.weights[have], n_groups) * _impacts(tfs[group], unit["m"])
        sizes = group_places[group + 1] - group_places[group]
        value, place = np.repeat(impact, sizes), places[_ranges(group_places[group], sizes)].astype(np.int64)
        begin, count = np.zeros(len(asked.terms), np.int64), np.zeros(len(asked.terms), np.int64)
        count[have] = group_places[term_groups[at + 1]] - group_places[term_groups[at]]
        begin[have] = np.cumsum(count[have]) - count[have]
        step = max(1, CELLS // size)
        for first in range(0, len(chosen), step):
            some = chosen[first : first + step]
            acc = np.zeros(len(some) * size, np.int64)
            number = np.full(len(asked.ids), -1)
            number[some] = np.arange(len(some))
            pair = np.flatnonzero((number[asked.item] >= 0) & (count[asked.term] > 0))
            held, part = np.cumsum(count[asked.term[pair]]), 0
            while part < len(pair):
                stop = max(part + 1, int(np.searchsorted(held, (held[part - 1] if part else 0) + CELLS, "right")))
                own = pair[part:stop]
                times = count[asked.term[own]]
                posting = _ranges(begin[asked.term[own]], times)
                acc += _sums(np.repeat(number[asked.item[own]] * size, times) + place[posting], value[posting], len(acc), most)
                part = stop
            yield best(acc.reshape(len(some), size), some, ids)

    def best(scores: np.ndarray, some: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        least = np.maximum(threshold[some], 1)
        if scores.shape[1] > k:
            least = np.maximum(least, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
        row, doc = np.nonzero(scores >= least[:, None])
        order = np.lexsort((ids[doc], -scores[row, doc], row))
        row, doc = row[order], doc[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, doc = row[keep], doc[keep]
        return pa.RecordBatch.from_arrays([pa.array(some[row]), pa.array(ids[doc]), pa.array(scores[row, doc])], ["item", "doc_id", "score"])

    return index.units.mapInArrow(visited, "item long, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))).where(F.col("rank") <= k)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, hashes, bounds in _term_hashes(batch.column(1)):
            item = batch.column(0).take(pa.array(first + np.searchsorted(bounds, np.arange(len(hashes)), "right") - 1, pa.int64()))
            yield pa.RecordBatch.from_arrays([item, pa.array(hashes.view(np.int64))], ["item_id", "term"])


def search(index: LexicalIndex, items: DataFrame, scratch: Scratch, k: int = 10, name: str = "search") -> DataFrame:
    """(item_id, rank, doc_id, score): of each item the k documents with the highest scores above 0, ties to the smaller doc_id; fewer where there are fewer.

    An item's terms count once each; rows of one item_id are one item, and rows without an id or without a term find nothing. A term's weight is
    floor(1000 * ln((2N + 2) / (2 * df + 1))), and a document's score the sum of weight * ((10^9 * tf) div (1000 * tf + 8 * m)).
    """
    spark = items.sparkSession
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    terms = scratch.keep(rows.mapInArrow(_item_terms, "item_id long, term long").distinct(), f"{name}-terms")
    blocks = max(1, -(-terms.count() * 16 // ITEM_BYTES))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        asked = _Asked([tuple(r) for r in terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()])
        if not len(asked.ids) or not index.documents:
            continue
        asked.weigh(_frequencies(index, asked), index.documents)
        bounds = scratch.keep(_stratum_bounds(index, asked), f"{name}-bounds-{b}")
        before = F.sum("docs").over(Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1))
        ordered = bounds.withColumn("before", F.coalesce(before, F.lit(0)))
        size, threshold, high = len(asked.ids), np.zeros(len(asked.ids), np.int64), np.full(len(asked.ids), np.iinfo(np.int64).max)
        parts = []
        for r, share in enumerate((*ROUNDS, None)):
            low = threshold.copy()
            if share is not None:
                until = max(k, int(index.documents * share))
                cuts = ordered.where(F.col("before") < until).groupBy("item").agg(F.min("bound").alias("bound")).collect()
                cut = np.zeros(size, np.int64)
                for row in cuts:
                    cut[row["item"]] = row["bound"]
                low = np.maximum(low, cut)
            parts.append(scratch.keep(_best(_visit(index, asked, low, high, threshold, k), k).select("item", "doc_id", "score"), f"{name}-found-{b}-{r}"))
            found = parts[0]
            for more in parts[1:]:
                found = found.unionByName(more)
            top = _best(found, k)
            if share is not None:
                for row in top.where(F.col("rank") == k).collect():
                    threshold[row["item"]] = row["score"]
                high = np.minimum(high, low)
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(asked.ids)], "own_item long, item_id long")
        named = top.join(F.broadcast(names), F.col("item") == F.col("own_item"))
        out = out.unionByName(named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The documents indexed and searched for all items; see `build_index` and `search`. Columns other than ids and texts are not read."""
    scratch = Scratch(docs.sparkSession)
    return search(build_index(docs, scratch), items, scratch, k)
