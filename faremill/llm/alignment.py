"""Two tokenizers' ids of the same texts, aligned by the bytes they cover.

Both tokenizers cut the same bytes; where a token of one and a token of the other end at the same byte, a group of
tokens ends. The common ends come from a galloping intersection: the shorter list of ends drives an exponential and then a binary search
into the longer. The common ends' ranks slice both lists into groups, and the ranks' differences say how many tokens of
each side overlap there. Every pair of ids within a group is a link.

How many documents hold a pair is counted over the whole corpus: chunks of documents name their distinct pairs once, the counts
are added by pair, joined back to the chunks, and summed for each document there.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.packing import plain_encoder
from faremill.llm.scratch import Scratch

#: Characters of text in a chunk, or one text.
CHUNK = 2_000_000
#: Segments whose ids under B a task keeps from chunk to chunk, and the most characters of one.
KEPT, KEPT_WIDTH = 200_000, 64
#: Links of one group beyond which its pairs are counted instead of listed.
LISTED = 4096
#: A space after a character that is no whitespace begins a token of B.
SEGMENT = re.compile(r"(?<=\S) ")


def gallop(short: np.ndarray, long: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of `short`, its place among long[low:high], which is sorted, or that of the first larger one; high where there is none.

    The search for a value starts at the place `at`, whatever that is, moves away in steps that double until the value is bracketed,
    and halves the bracket. All values are searched for at once, and one that is bracketed takes part in no further step.
    """
    first, last = low.copy(), high.copy()
    at = np.clip(at, low, np.maximum(low, high - 1))
    some = np.flatnonzero(low < high)
    up = long[at[some]] < short[some]
    for side, todo in ((1, some[up]), (-1, some[~up])):
        # What is known of the bracket's one end, and the next place to look at for the other.
        if side == 1:
            first[todo] = at[todo] + 1
        else:
            last[todo] = at[todo]
        step = 1
        while len(todo):
            probe = at[todo] + side * step
            inside = probe < high[todo] if side == 1 else probe >= low[todo]
            todo, probe = todo[inside], probe[inside]
            below = long[probe] < short[todo]
            first[todo[below]] = np.maximum(first[todo[below]], probe[below] + 1)
            last[todo[~below]] = np.minimum(last[todo[~below]], probe[~below])
            todo = todo[below] if side == 1 else todo[~below]
            step *= 2
    todo = np.flatnonzero(first < last)
    while len(todo):
        middle = (first[todo] + last[todo]) // 2
        below = long[middle] < short[todo]
        first[todo[below]] = middle[below] + 1
        last[todo[~below]] = middle[~below]
        todo = todo[first[todo] < last[todo]]
    return first


def common_ends(ends_a: np.ndarray, starts_a: np.ndarray, ends_b: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where both lists of ends have the same value, row by row: the places in a and in b. `starts` says where each row's ends begin, and the list's end."""
    size_a, size_b = np.diff(starts_a), np.diff(starts_b)
    found = []
    for rows, short, s_short, long, s_long, swap in (
        (np.flatnonzero(size_a <= size_b), ends_a, starts_a, ends_b, starts_b, False),
        (np.flatnonzero(size_a > size_b), ends_b, starts_b, ends_a, starts_a, True),
    ):
        n = s_short[rows + 1] - s_short[rows]
        own = np.repeat(rows, n)
        place = np.repeat(s_short[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        low, high = s_long[own], s_long[own + 1]
        # The longer list is about as far on, in proportion.
        guess = low + (place - s_short[own]) * (high - low) // np.maximum(1, s_short[own + 1] - s_short[own])
        at = gallop(short[place], long, low, high, guess)
        ok = at < high
        ok[ok] = long[at[ok]] == short[place[ok]]
        found.append((at[ok], place[ok]) if swap else (place[ok], at[ok]))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


class Tokenizers:
    """Both tokenizers, and B's ids of segments already seen.

    B has no piece that goes on over a space behind another character, so texts are cut there, each distinct segment is encoded once, and
    the segments' ids are the text's.
    """

    def __init__(self, ranks_path: str, model_path: str):
        import sentencepiece

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encode_a = plain_encoder(ranks)
        bytes_a = sorted(ranks, key=ranks.__getitem__)
        if [ranks[t] for t in bytes_a] != list(range(len(ranks))):
            raise ValueError(f"{ranks_path} must rank its tokens from 0 without gaps")
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"{model_path} has pieces that go on over a space")
        byte = [re.fullmatch("<0x([0-9A-F]{2})>", p) for p in pieces]
        bytes_b = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for m, p in zip(byte, pieces, strict=True)]
        #: The bytes of every id of A, and of B.
        self.bytes = (bytes_a, bytes_b)
        self.lengths = [np.array([len(t) for t in known], np.int64) for known in self.bytes]
        # B puts a space before every text but the empty one.
        self.space_b = np.array([self.model.piece_to_id("▁")], np.int32).tobytes()
        self.kept: dict[str, bytes] = {"": self.space_b}

    def _ids_b(self, texts: list[str]) -> list[np.ndarray]:
        """B's ids of each text, which is not empty."""
        split = [SEGMENT.split(t) for t in texts]
        if len(self.kept) > KEPT:
            self.kept = {"": self.space_b}
        missing = [s for s in set(chain.from_iterable(split)) if s not in self.kept]
        found = self.model.encode(missing)
        ids = np.fromiter(chain.from_iterable(found), np.int32).tobytes()
        ends = np.cumsum([0, *(4 * len(f) for f in found)]).tolist()
        self.kept.update((s, ids[a:b]) for s, a, b in zip(missing, ends[:-1], ends[1:], strict=True))
        out = [np.frombuffer(b"".join(map(self.kept.__getitem__, parts)), np.int32) for parts in split]
        for s in missing:
            if len(s) > KEPT_WIDTH:
                del self.kept[s]
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids under A and B of a space and each text, which is not empty, or nothing where the bytes of either aren't those of the text."""
        out = []
        for text, b in zip(texts, self._ids_b(texts), strict=True):
            a, whole = self.encode_a(" " + text), (" " + text).encode()
            same = all(b"".join(map(known.__getitem__, ids)) == whole for known, ids in zip(self.bytes, (a, b.tolist()), strict=True))
            out.append((np.array(a, np.int32), b) if same else None)
        return out


def _digits(size: int) -> np.ndarray:
    """The decimal digits of 0 .. size - 1, right-aligned, 0 where there is none, and a last column for a separator."""
    width = len(str(max(1, size - 1)))
    out = np.zeros((size, width + 1), np.uint8)
    number = np.arange(size)
    for c in range(width - 1, -1, -1):
        left = number // 10 ** (width - 1 - c)
        out[:, c] = np.where((left > 0) | (c == width - 1), 48 + left % 10, 0)
    return out


def _listed(ids: np.ndarray, counts: np.ndarray, digits: np.ndarray, inner: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids as bytes with separators behind them, `last` behind the last of each group, and each id's number of bytes."""
    shown = digits[ids]
    shown[:, -1] = inner
    shown[np.cumsum(counts) - 1, -1] = last
    solid = shown != 0
    return shown[solid], solid.sum(axis=1)


class Aligner:
    """Texts aligned a chunk at a time."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.base = len(tokenizers.bytes[1])
        self.digits = [_digits(len(known)) for known in tokenizers.bytes]

    def align(self, texts: list[str | None]) -> tuple[list[dict], np.ndarray, np.ndarray]:
        """For each text its numbers, hash and pairs; the chunk's distinct pairs, as a * (ids of B) + b, and how many of the texts hold each."""
        encoded = iter(self.tokenizers.encode([t for t in texts if t]))
        found = [next(encoded) if t else None for t in texts]
        sides, starts, ends = [], [], []
        for side in (0, 1):
            parts = [f[side] if f else np.zeros(0, np.int32) for f in found]
            sizes = [len(p) for p in parts]
            ids = np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int64)
            start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            end = np.cumsum(self.tokenizers.lengths[side][ids])
            before = np.concatenate([[0], end])[start[:-1]]
            sides.append(ids)
            starts.append(start)
            ends.append(end - np.repeat(before, sizes))
        in_a, in_b = common_ends(ends[0], starts[0], ends[1], starts[1])
        row = np.searchsorted(starts[0], in_a, "right") - 1
        # A row's last ends are common, so a group begins behind the one before it.
        counts = [np.diff(np.concatenate([[-1], at])) for at in (in_a, in_b)]
        n_groups = np.bincount(row, minlength=len(texts))
        links = counts[0] * counts[1]
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, row, links)
        row_of, code, times = self._pairs(sides, [in_a, in_b], counts, links, row)
        pairs, pair = np.unique(code, return_inverse=True)
        held, which = np.unique(row_of * max(1, len(pairs)) + pair, return_inverse=True)
        n_times = np.zeros(len(held), np.int64)
        np.add.at(n_times, which, times)
        held_row, held_pair = held // max(1, len(pairs)), held % max(1, len(pairs))
        cut = np.searchsorted(held_row, np.arange(len(texts) + 1))
        hashes = self._hashes(sides, counts, n_groups, starts)
        rows = [
            {
                "n_a": int(starts[0][i + 1] - starts[0][i]), "n_b": int(starts[1][i + 1] - starts[1][i]), "n_groups": int(n_groups[i]), "n_links": int(n_links[i]),
                "groups_sha256": hashes[i], "pairs": held_pair[cut[i] : cut[i + 1]].astype(np.uint32).tobytes(), "times": n_times[cut[i] : cut[i + 1]].tobytes(),
            }
            for i in range(len(texts))
        ]
        return rows, pairs, np.bincount(held_pair, minlength=len(pairs))

    def _pairs(self, sides: list, at: list, counts: list, links: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all groups' links the row, the pair and how many of it; groups with very many links are counted by distinct ids."""
        first = [a - c + 1 for a, c in zip(at, counts, strict=True)]
        small = np.flatnonzero(links <= LISTED)
        n = links[small]
        group = np.repeat(small, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a = sides[0][first[0][group] + nth // counts[1][group]]
        b = sides[1][first[1][group] + nth % counts[1][group]]
        out = [(row[group], a * self.base + b, np.ones(len(group), np.int64))]
        for g in np.flatnonzero(links > LISTED).tolist():
            (ids_a, n_a), (ids_b, n_b) = (np.unique(s[f[g] : f[g] + c[g]], return_counts=True) for s, f, c in zip(sides, first, counts, strict=True))
            code = (ids_a[:, None] * self.base + ids_b[None, :]).ravel()
            out.append((np.full(len(code), row[g]), code, (n_a[:, None] * n_b[None, :]).ravel()))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _hashes(self, sides: list, counts: list, n_groups: np.ndarray, starts: list) -> list[str]:
        """Of each row the hash of its groups, written as a1,a2|b1;a3|b2,b3."""
        if not len(counts[0]):
            return [""] * len(n_groups)
        (bytes_a, size_a), (bytes_b, size_b) = (_listed(s, c, d, ord(","), ord(last)) for s, c, d, last in zip(sides, counts, self.digits, "|;", strict=True))
        # A group's bytes are those of its ids of A, then of B.
        of_a, of_b = (np.add.reduceat(size, np.cumsum(c) - c) for size, c in zip((size_a, size_b), counts, strict=True))
        out = np.empty(len(bytes_a) + len(bytes_b), np.uint8)
        is_a = np.repeat(np.tile([True, False], len(of_a)), np.stack([of_a, of_b], axis=1).ravel())
        out[is_a], out[~is_a] = bytes_a, bytes_b
        group_end = np.concatenate([[0], np.cumsum(of_a + of_b)])
        row_end = group_end[np.concatenate([[0], np.cumsum(n_groups)])]
        whole = out.tobytes()
        return [hashlib.sha256(whole[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(row_end[:-1].tolist(), row_end[1:].tolist(), strict=True)]


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
#: A document of a chunk has the first columns, a chunk's list of pairs the last.
ALIGNED = f"chunk long, {DOCUMENT}, chunk_pairs binary, chunk_docs binary"
TOLD = "chunk long, kind int, place long, docs long, best boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _aligned(ranks_path: str, model_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents to rows of ALIGNED: each chunk's documents, then its distinct pairs."""
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, number = None, TaskContext.get().partitionId(), 0
        for batch in batches:
            aligner = aligner or Aligner(Tokenizers(ranks_path, model_path))
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = [len(t) if (t := x.as_py()) else 0 for x in texts]
            low, held = 0, 0
            for i, size in enumerate(sizes):
                held += size
                if i + 1 < len(sizes) and held + sizes[i + 1] <= CHUNK:
                    continue
                rows, pairs, docs = aligner.align(texts.slice(low, i + 1 - low).to_pylist())
                chunk = task << 32 | number
                out = [{"chunk": chunk, "doc_id": d} | r for d, r in zip(ids[low : i + 1], rows, strict=True)]
                out.append({"chunk": chunk, "chunk_pairs": pairs.astype(np.int64).tobytes(), "chunk_docs": docs.astype(np.int64).tobytes()})
                columns = [pa.array([r.get(c) for r in out], t) for c, t in zip(names, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)
                low, held, number = i + 1, 0, number + 1

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, pairs, docs in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            pair = np.frombuffer(pairs, np.int64)
            columns = [np.full(len(pair), chunk), np.arange(len(pair)), pair, np.frombuffer(docs, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["chunk", "place", "pair", "docs"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks, each with the counts of its pairs by place and then its documents: what the documents' links add up to."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key, parts, docs, best = None, [], np.zeros(0, np.int64), np.zeros(0, bool)
    for batch in batches:
        chunk, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edge = np.flatnonzero((chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])) + 1
        for low, high in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            if int(chunk[low]) != key:
                key, parts, docs, best = int(chunk[low]), [], np.zeros(0, np.int64), np.zeros(0, bool)
            if not kind[low]:
                parts.append((part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False)))
                continue
            if parts:
                docs, best, parts = np.concatenate([docs, *(p[0] for p in parts)]), np.concatenate([best, *(p[1] for p in parts)]), []
            n_best, count_sum = [], []
            for pairs, times in zip(part.column(11).to_pylist(), part.column(12).to_pylist(), strict=True):
                at, n = np.frombuffer(pairs, np.uint32), np.frombuffer(times, np.int64)
                n_best.append(int(n[best[at]].sum()))
                count_sum.append(int((n * docs[at]).sum()))
            own = [part.column(c) for c in (5, 6, 7, 8, 9)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), part.column(10)], names)


class Alignment:
    """The alignment of a table's texts, written once, from which pairs and documents are read."""

    def __init__(self, docs: DataFrame, ranks_path: str, model_path: str):
        """`ranks_path`: a file of byte-level tokens and their ranks (A); `model_path`: a piece model with byte fallback (B)."""
        self.base = _pieces(model_path)
        self.scratch = Scratch(docs.sparkSession)
        asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        self.table = self.scratch.keep(asked.mapInArrow(_aligned(ranks_path, model_path), ALIGNED), "aligned")
        chunks = self.table.where("chunk_pairs IS NOT NULL").select("chunk", "chunk_pairs", "chunk_docs")
        self.exploded = chunks.mapInArrow(_exploded, "chunk long, place long, pair long, docs long")
        counts = self.exploded.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.expr(f"pair div {self.base}"))
        counts = self.scratch.keep(counts, "counts")
        most = counts.groupBy("a").agg(F.max("docs").alias("most"))
        self.counted = counts.join(most, "a").select("pair", F.col("docs").alias("all_docs"), (F.col("docs") == F.col("most")).alias("best"))

    def pairs(self) -> DataFrame:
        """(a, b, docs, best): each pair of ids that a document holds linked, by how many it is held, and whether no pair of its id of A is by more."""
        return self.counted.select(F.expr(f"pair div {self.base}").alias("a"), (F.col("pair") % self.base).alias("b"), F.col("all_docs").alias("docs"), "best")

    def documents(self) -> DataFrame:
        """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; see `align_documents`."""
        found = self.exploded.select("chunk", "place", "pair").join(self.counted, "pair")
        nothing = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in DOCUMENT.split(", ")]
        counts = found.select("chunk", F.lit(0).alias("kind"), "place", F.col("all_docs").alias("docs"), "best", *nothing)
        own = self.table.where("chunk_pairs IS NULL").select(
            "chunk", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("docs"), F.lit(False).alias("best"), *(c.split()[0] for c in DOCUMENT.split(", "))
        )
        both = counts.unionByName(own).repartition("chunk").sortWithinPartitions("chunk", "kind", "place")
        schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        return both.mapInArrow(_summed, schema)


def _pieces(model_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size()


def align_documents(docs: DataFrame, ranks_path: str, model_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A's and B's tokens of a space and the text, special tokens' strings being plain text; the groups between common ends; the links, which are the pairs of
    token occurrences that share a group; those of them whose pair of ids no other pair of the same id of A is held by more documents; and the
    sum over the links of the number of documents that hold their pair. groups_sha256 is the hash of the groups' ids, written a1,a2|b1;a3|b2,b3.
    A text that is NULL, empty, or whose tokens' bytes under A or B differ from it has no tokens: zeros and an empty hash. Rows that repeat a
    doc_id, or have none, are documents of their own. Columns other than doc_id and text are not read. Memory grows with the longest text.
    """
    return Alignment(docs, ranks_path, model_path).documents()
