"""Documents packed into windows of a model's length by non-negative least squares.

A document's ids are cut into whole windows and a remainder. How often each remainder length
occurs is all that planning needs: combinations of up to three lengths that fill a window exactly
are enumerated, repeat counts for them are solved against the histogram by non-negative least
squares and rounded. What the rounded counts leave over is packed greedily: laid end to end, longest
first, and cut where a window is full, so only the last sequence is ever short. Histogram and
plan depend on the window, not on the corpus. Spark then numbers the pieces of each length
and looks their places up in the plan.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.scratch import Scratch

WINDOW = 1024
#: The id that ends a document.
END_ID = 0
#: The pattern by which the vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What the pattern takes for whitespace, and how long a run of it may be for the pattern's engine, which has been seen to fail at 1,000,000.
WHITESPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 100_000
LONG_RUNS = re.compile(f"(?<![{WHITESPACE}])[{WHITESPACE}]{{{LONG_RUN},}}")
#: Pieces numbered together: the share of a length that one group takes.
SHARE = 20_000


def plain_encoder(ranks: dict[bytes, int], pattern: str = PATTERN) -> Callable[[str], list[int]]:
    """The ids of a text under the ranks by `tiktoken`, special tokens being ordinary text.

    Under PATTERN whitespace runs may have any length. The pattern takes a run up to its last character, or to the text's end, as one
    piece, and goes on from there; long runs are cut out as such pieces, so its engine never sees them. Other patterns go to the
    engine as they are.
    """
    import tiktoken

    encoding = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    if pattern != PATTERN:
        return encoding.encode_ordinary

    def ids_of(text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return encoding.encode_ordinary(text)
        out, at = [], 0
        for m in LONG_RUNS.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += encoding.encode_ordinary(text[at : m.start()])
            out += encoding._encode_single_piece(text[m.start() : end])
            at = end
        return out + encoding.encode_ordinary(text[at:])

    return ids_of


def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """The ids of a text under a byte-level BPE vocabulary file of the `tokenizers` library.

    Its vocabulary is its merge order, which is all that `tiktoken` needs to give the same ids at three
    times the speed. As there, the file's added tokens are cut out of the text first (of those that begin at one place the longest),
    and each gives its own id; ones that must stand alone or take blanks with them are refused.
    """
    with open(vocabulary, encoding="utf-8") as f:
        saved = json.load(f)
    special = {t["content"]: t["id"] for t in saved.get("added_tokens", []) if t["content"]}
    if any(t.get(rule) for t in saved.get("added_tokens", []) for rule in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens with single_word, lstrip or rstrip are not supported")
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    ranks = {bytes(shown[c] for c in token): i for token, i in saved["model"]["vocab"].items() if token not in special}
    plain_ids = plain_encoder(ranks)
    if not special:
        return plain_ids
    added = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")

    def ids_of(text: str) -> list[int]:
        first, *rest = added.split(text)
        out = plain_ids(first)
        for token, part in zip(rest[::2], rest[1::2], strict=True):
            out.append(special[token])
            out += plain_ids(part)
        return out

    return ids_of


def combinations(window: int) -> np.ndarray:
    """Rows of lengths (a <= b <= c, 0 where fewer) below the window that fill it exactly: two or three of them."""
    a, b = np.meshgrid(np.arange(0, window // 3 + 1), np.arange(1, window // 2 + 1), indexing="ij")
    rows = np.stack([a.ravel(), b.ravel(), window - a.ravel() - b.ravel()], axis=1)
    return rows[(rows[:, 0] <= rows[:, 1]) & (rows[:, 1] <= rows[:, 2]) & (rows[:, 2] < window)]


def solve_repeats(ways: np.ndarray, histogram: np.ndarray, rounds: int = 12) -> np.ndarray:
    """x >= 0 that brings the used lengths near the histogram in least squares: an active-set method.

    Each round frees the ways with the steepest gradients, no two of which share a length, solves the
    free ones exactly and fixes those at zero that would be negative, until none is.
    """
    size, scale = len(histogram), max(1.0, float(np.median(histogram[histogram > 0])))
    x, free = np.zeros(len(ways)), np.zeros(len(ways), bool)
    usable = np.all((histogram[ways] > 0) | (ways == 0), axis=1)
    left = histogram.copy()
    for _ in range(rounds):
        left[0] = 0
        gain = left[ways].sum(axis=1)
        gain[free | ~usable] = -np.inf
        steep = np.argsort(-gain, kind="stable")[: 4 * size]
        taken, added = np.zeros(size, bool), 0
        for w in steep[gain[steep] > 0.01 * scale].tolist():
            own = [v for v in ways[w] if v]
            if not taken[own].any():
                taken[own] = True
                free[w], added = True, added + 1
        if not added:
            break
        while True:
            at = np.flatnonzero(free)
            used = np.zeros((size, len(at)))
            for k in range(ways.shape[1]):
                used[ways[at, k], np.arange(len(at))] += 1
            used[0] = 0
            best = np.linalg.solve(used.T @ used + 1e-6 * np.eye(len(at)), used.T @ histogram)
            if (best > 0).all():
                break
            free[at[best <= 0]] = False
        x[:] = 0
        x[at] = best
        left = histogram - used @ best
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, low, high, sequence, each, offset) for a histogram over the lengths 0 to `window`.

    The pieces of a length numbered low to high - 1 go, `each` to a sequence, into the sequences from `sequence` on, one
    after another from `offset`. Where `each` is 0 they lie end to end, `offset` ids after the beginning of `sequence`.
    There are at most three rows for each way that is used and one more for each length.
    """
    left = histogram.astype(np.int64).copy()
    done, rows, sequence = np.zeros(window + 1, np.int64), [], 0
    if left[window]:
        rows.append((window, 0, int(left[window]), 0, 1, 0))
        sequence, left[window] = int(left[window]), 0
    ways = combinations(window)
    repeats = solve_repeats(ways, left[:window].astype(float)) if left.any() else np.zeros(len(ways))
    for w in np.argsort(-repeats, kind="stable").tolist():
        if repeats[w] < 0.5:
            break
        lengths, each = np.unique(ways[w][ways[w] > 0], return_counts=True)
        count = int(min(round(repeats[w]), (left[lengths] // each).min()))
        offset = 0
        for length, k in zip(lengths.tolist() if count else (), each.tolist(), strict=False):
            rows.append((length, int(done[length]), int(done[length]) + count * k, sequence, k, offset))
            done[length] += count * k
            left[length] -= count * k
            offset += length * k
        sequence += count
    position = 0
    for length in np.flatnonzero(left)[::-1].tolist():
        rows.append((length, int(done[length]), int(done[length] + left[length]), sequence, 0, position))
        position += length * int(left[length])
    return rows


def pieces(docs: DataFrame, vocabulary: str, window: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, rest): every document's ids, and the id that ends it, in
    windows and a remainder; rest: the ids of a remainder, which may be cut once more."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part, out = batch.slice(first, 500), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = np.array([*ids_of(text.as_py() or ""), END_ID], "<u4")
                    for start in range(0, len(ids), window):
                        own = ids[start : start + window].tobytes()
                        out.append((doc_id, start, len(own) // 4, zlib.crc32(own), len(ids), own if len(own) < 4 * window else None))
                *numbers, rest = zip(*out, strict=True)
                columns = [*(pa.array(c, pa.int64()) for c in numbers), pa.array(rest, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rest"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return asked.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rest binary")


PLACED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _cut_at_windows(window: int):  # noqa: ANN202
    """A piece that reaches over the end of its sequence becomes two; both get their own checksum."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from over(batch)

    def over(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        whole = batch.select(list(PLACED))
        split = batch.column("offset").to_numpy() + batch.column("length").to_numpy() > window
        yield whole.filter(pa.array(~split))
        out = []
        for r in batch.filter(pa.array(split)).to_pylist():
            size = window - r["offset"]
            for ids, start, sequence, offset in (
                (r["rest"][: 4 * size], r["start"], r["sequence_id"], r["offset"]),
                (r["rest"][4 * size :], r["start"] + size, r["sequence_id"] + 1, 0),
            ):
                out.append(r | {"start": start, "length": len(ids) // 4, "ids_crc32": zlib.crc32(ids), "sequence_id": sequence, "offset": offset})
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out]).cast(whole.schema.field(c).type) for c in PLACED], list(PLACED))

    return cut


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    Every sequence holds `window` ids but the last, which may hold fewer. A NULL or empty text is the
    ending id alone. Rows with a NULL or a repeated doc_id are documents of their own. Columns
    other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    cut = Scratch(spark).keep(pieces(docs, vocabulary, window), "pieces")
    histogram = np.zeros(window + 1, np.int64)
    for length, count in cut.groupBy("length").count().collect():
        histogram[length] = count
    places = spark.createDataFrame(plan(histogram, window), "size long, low long, high long, sequence long, each long, first long")

    shares = max(1, -(-int(histogram.max()) // SHARE))
    share = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares))
    dealt = cut.withColumn("share", share)
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    base = base.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = dealt.withColumn("n", F.row_number().over(within) - 1).join(base, ["length", "share"])
    numbered = numbered.withColumn("n", F.col("n") + F.col("base"))
    # The plan's size is bounded by the window, whatever the corpus.
    placed = numbered.join(F.broadcast(places), (F.col("length") == F.col("size")) & (F.col("n") >= F.col("low")) & (F.col("n") < F.col("high")))
    laid = placed.withColumn("nth", F.col("n") - F.col("low")).withColumn("position", F.col("first") + F.col("nth") * F.col("length"))
    slot = F.expr("IF(each = 0, position DIV {0}, nth DIV each)".format(window))
    offset = F.expr("IF(each = 0, position % {0}, first + nth % each * length)".format(window))
    laid = laid.withColumns({"sequence_id": F.col("sequence") + slot, "offset": offset}).select(*PLACED, "rest")
    return laid.mapInArrow(_cut_at_windows(window), ", ".join(f"{c} long" for c in PLACED))
