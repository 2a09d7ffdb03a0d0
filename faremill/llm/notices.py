"""Licence notices, exact and with errors.

Texts are reduced to words (lower case, everything else a single space). Phrases are found word by word. Notices are
found with a bounded number of edits: a notice that may have e errors is split into e + 1 pieces, one of which a
match must hold unchanged; an automaton finds the pieces, and around each the regex library looks for the
whole notice with at most e errors, from the begin of a word to the end of one.

Errors are for the words that connect. What tells one licence from another, its name and version, must stand unchanged, in the notice's order and
without another number or variant among or behind it.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.texts import slices, span_hashes, table, words

#: Bytes that no word holds: all below 128 but digits and lower-case letters.
BREAKS = tuple(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Licences by the words of their names, with the versions there are. A version's dot is a space between words.
FAMILIES = (
    ("gpl", "gnu general public license", ("1", "2", "3")),
    ("lgpl", "gnu lesser general public license", ("2 1", "3")),
    ("lgpl", "gnu library general public license", ("2",)),
    ("agpl", "gnu affero general public license", ("3",)),
    ("apache", "apache license", ("1 0", "1 1", "2")),
    ("mpl", "mozilla public license", ("1 0", "1 1", "2")),
    ("epl", "eclipse public license", ("1", "2")),
    ("cddl", "common development and distribution license", ("1 0", "1 1")),
    ("artistic", "artistic license", ("1", "2")),
    ("bsl", "boost software license", ("1",)),
    ("eupl", "european union public license", ("1 1", "1 2")),
)
#: Ways to write a version before its number, and what a whole version may have behind it.
VERSIONED, WHOLE = ("version", "v"), (" 0", "")
# Names that stand before the word license, and variants of Creative Commons.
SHORT_NAMES = ("mit", "bsd", "isc", "mpl", "bsl", "gpl", "lgpl", "agpl", "epl", "zlib", "unlicense", "wtfpl", "cddl", "eupl")
COMMONS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
# Notices that name no licence, and the words of them that must stand.
WORDINGS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source binary"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "fee"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("all-rights-reserved", "all rights reserved", "all"),
)


def wordings() -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """(label, notice, words that must stand) of everything that is looked for."""
    found = [(label, text, tuple(keys.split())) for label, text, keys in WORDINGS]
    connecting = ("license", "public", "and", "software")
    for label, name, versions in FAMILIES:
        keys = [w for w in name.split() if w not in connecting]
        for version in versions:
            tails = [version] if " " in version else [version + behind for behind in WHOLE]
            for word, tail in ((w, t) for w in VERSIONED for t in tails):
                found.append((f"{label}-{version.replace(' ', '.')}", f"{name} {word} {tail}", (*keys, *tail.split())))
    found += [(name, f"{way}under the {name} license", (name,)) for name in SHORT_NAMES for way in ("", "released ", "licensed ")]
    found += [(f"cc-{variant.replace(' ', '-')}", f"licensed under cc {variant}", ("cc", *variant.split())) for variant in COMMONS]
    return tuple(found)


NOTICES = wordings()
#: Words of Creative Commons variants; like numbers, one more of them behind or among a notice's makes it another licence.
TELLING = frozenset("by sa nd nc".split())

#: One error for so many characters of a notice.
CHARS_PER_ERROR = 14

FOUND = "array<struct<label:string,word:long,n_words:long,errors:int,score:double,text:string>>"


def _telling(words_of: list[str], commons: bool) -> list[str]:
    """The numbers among the words, and the words of variants."""
    return [w for w in words_of if w.isdigit() or commons and w in TELLING]


class NoticeFinder:
    """The automaton over the pieces of all notices, and their patterns."""

    def __init__(self, notices: tuple[tuple[str, str, tuple[str, ...]], ...], chars_per_error: int):
        self.notices = [(label, text, keys, len(text) // chars_per_error) for label, text, keys in notices]
        self.patterns = [regex.compile(f"(?b)(?<![^ ])(?:{regex.escape(text, literal_spaces=True)}){{e<={e}}}(?![^ ])") for _, text, _, e in self.notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, _, e) in enumerate(self.notices):
            cuts = np.linspace(0, len(text), e + 2).astype(int).tolist()
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                pieces.setdefault(text[low:high], []).append((n, low))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def stands(self, n: int, text: str, begin: int, end: int) -> bool:
        """Whether the words that tell a notice from others stand unchanged in a match, and no more such words among and behind them."""
        _, notice, keys, _ = self.notices[n]
        found = text[begin:end].split()
        rest = iter(found)
        if not all(k in rest for k in keys):
            return False
        commons = "cc" in keys
        if _telling(found, commons) != _telling(notice.split(), commons):
            return False
        # Behind a version there must be no further part of it, and behind a variant none of another.
        behind = text[end : end + 24].split()[:1]
        return not (notice.split()[-1].isdigit() and behind and behind[0].isdigit() or commons and behind and behind[0] in TELLING)

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, begin, end, errors, score) of the notices in a text of words; of overlapping ones the best."""
        places: set[tuple[int, int]] = set()
        for last, (size, owners) in self.automaton.iter(text):
            for n, offset in owners:
                places.add((n, last - size + 1 - offset))
        spans, done = set(), (-1, 0)
        for n, at in sorted(places):
            label, notice, keys, e = self.notices[n]
            low, high = max(0, at - 2 * e), min(len(text), at + len(notice) + 3 * e)
            # What a place before this one has found, or has looked through, isn't looked at again.
            if done[0] == n:
                low = max(low, done[1])
            window = f" {text[low:high]} "
            if not all(f" {k} " in window for k in keys):
                continue
            while low < high:
                m = self.patterns[n].search(text, low, min(len(text), high + 1))
                if not m:
                    break
                begin, end = m.span()
                # The regex library may count the blanks around as errors.
                begin, end = begin + (text[begin:end] != text[begin:end].lstrip(" ")), end - (text[begin:end] != text[begin:end].rstrip(" "))
                if self.stands(n, text, begin, end):
                    errors = sum(m.fuzzy_counts)
                    spans.add((1 - errors / len(notice), end - begin, begin, end, errors, label))
                    done = n, max(begin + 1, m.end())
                    break
                # Another match may begin behind the begin of one that doesn't stand.
                low = m.start() + 1
        out, taken = [], []
        for score, _, begin, end, errors, label in sorted(spans, key=lambda s: (-s[0], -s[1], s[2:])):
            i = bisect(taken, (begin, end))
            if (i == 0 or taken[i - 1][1] <= begin) and (i == len(taken) or taken[i][0] >= end):
                taken.insert(i, (begin, end))
                out.append((label, begin, end, errors, score))
        return sorted(out, key=lambda s: s[1:])


def notices_in(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: tuple[tuple[str, str, tuple[str, ...]], ...] = NOTICES,
    chars_per_error: int = CHARS_PER_ERROR,
) -> DataFrame:
    """(doc_id, n_words, base, found) of every row: its number of words, the places of the phrases (label and first word), and the
    notices with at most one error for `chars_per_error` characters: label, first word, number of words, errors, score and the words.

    A NULL text is empty. Only doc_id and text are read.
    """
    phrases = PHRASES if phrases is None else phrases

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NoticeFinder(notices, chars_per_error)
        breaks = table(*BREAKS)
        wanted = []
        for phrase, label in phrases.items():
            raw = np.frombuffer(phrase.encode(), np.uint8)
            text, begin, end, _ = words(raw, np.array([0, len(raw)]), breaks)
            wanted.append((label, span_hashes(text, begin, end)))
        for batch in batches:
            for first, data, starts in slices(batch.column(1)):
                yield part(batch.column(0).slice(first, len(starts) - 1), data, starts, finder, breaks, wanted)

    def part(ids, data, starts, finder, breaks, wanted) -> pa.RecordBatch:  # noqa: ANN001
        text, begin, end, bounds = words(data, starts, breaks)
        hashes = span_hashes(text, begin, end)
        rows = len(starts) - 1
        base, found = [[] for _ in range(rows)], [[] for _ in range(rows)]
        for label, wants in wanted:
            n = len(wants)
            at = np.flatnonzero(hashes[: max(0, len(hashes) - n + 1)] == wants[0])
            for k in range(1, n):
                at = at[hashes[at + k] == wants[k]]
            row = np.searchsorted(bounds, at, "right") - 1
            for w, r in zip(at.tolist(), row.tolist(), strict=True):
                if w + n <= bounds[r + 1]:
                    base[r].append({"label": label, "word": w - int(bounds[r])})
        gap = breaks[text]
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        sums = np.concatenate([[0], np.cumsum(keep)])
        plain = np.where(gap, 32, text)[keep].astype(np.uint8).tobytes()
        edges = sums[starts + np.arange(rows + 1)].tolist()
        for r in range(rows):
            words_of = plain[edges[r] : edges[r + 1]].decode("utf-8", "replace").strip(" ")
            for label, low, high, errors, score in finder.find(words_of):
                shown = words_of[low:high]
                word = words_of.count(" ", 0, low)
                found[r].append({"label": label, "word": word, "n_words": len(shown.split(" ")), "errors": errors, "score": score, "text": shown})
        one = pa.struct([("label", pa.string()), ("word", pa.int64())])
        more = pa.struct([("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()), ("errors", pa.int32()), ("score", pa.float64()), ("text", pa.string())])
        columns = [ids, pa.array(np.diff(bounds), pa.int64()), pa.array(base, pa.list_(one)), pa.array(found, pa.list_(more))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "base", "found"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return asked.mapInArrow(scan, f"doc_id long, n_words long, base array<struct<label:string,word:long>>, found {FOUND}")


def notice_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found) of every row.

    n_base counts the phrases' places, first_word and last_word are the smallest and largest, NULL if there is none. base_labels and
    labels (with those of the notices) are distinct, sorted and joined by commas. score is 1 for a phrase, else the share of
    a notice's characters that is without error, at best; 0 without either.
    """
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, found = F.col("base.label"), F.col("found.label")
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("found.score"), F.lit(0.0)))
    return notices_in(docs).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, found)).alias("labels"), score.alias("score"), "found",
    )
