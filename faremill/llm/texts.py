"""Words, lines and their hashes for a whole Arrow column at once.

Hashes are 64 bits of a polynomial over the bytes, with random byte values and a final mixing
step. Everything works on bytes of UTF-8: the characters that separate words or lines and the
letters A-Z are single bytes there and never part of another character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once, and in one hash table of powers.
SLICE = 1 << 21
WHITE = (9, 10, 11, 12, 13, 32)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15


class Local(dict):
    """What a process has worked out for itself; travels empty with the functions that use it."""

    def __reduce__(self) -> tuple:
        return dict, ()


POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = Local()


def table(*members: int) -> np.ndarray:
    """True at the given byte values."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the seed's base modulo 2^64, and of its inverse."""
    kept = POWERS.get(seed)
    if kept is None or len(kept[0]) < n:
        size = max(n, SLICE + 1)
        base = (BASE * (2 * seed + 1)) % 2**64
        both = []
        for x in (base, pow(base, -1, 2**64)):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        kept = (both[0], both[1])
        if size == SLICE + 1:
            POWERS[seed] = kept
    return kept


def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64((BASE * (2 * seed + 3)) % 2**64))


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a text column, up to `limit` bytes or one row at a time: first row, bytes, where rows begin. NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def span_hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and don't overlap."""
    out = np.empty(len(begin), np.uint64)
    values = byte_values(seed)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + SLICE, "right")))
        low, high = int(begin[i]), int(end[j - 1])
        up, down = powers(high - low + 1, seed)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[text[low:high]] * up[: high - low], out=sums[1:])
        b, e = begin[i:j] - low, end[i:j] - low
        out[i:j] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
        i = j
    return out


def words(data: np.ndarray, starts: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased text with a space before every row, begin and end of each word in it, and each row's first word.

    `separators` is a table of the bytes that no word holds; a space is one of them.
    """
    text = LOWER[np.append(np.insert(data, starts[:-1], 32), np.uint8(32))]
    gap = separators[text]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    first = np.searchsorted(begin, starts + np.arange(len(starts)))
    return text, begin, end, first


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """At each word, a hash of the n words from it on; at the last n - 1 there is none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def shingle_sets(data: np.ndarray, starts: np.ndarray, n: int) -> list[np.ndarray]:
    """Of each row, the sorted distinct hashes of its n-word shingles; of fewer words, all of them as one; of none, nothing."""
    text, begin, end, first = words(data, starts, table(*WHITE))
    hashes = span_hashes(text, begin, end)
    all_grams = grams(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(all_grams[a : b - n + 1]))
        else:
            out.append(grams(hashes[a:b], b - a) if b > a else hashes[:0])
    return out
