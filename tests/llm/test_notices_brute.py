"""Licence notices against a scan of every window of words under every notice."""

from __future__ import annotations

import functools
import random
import re

import pytest

from faremill.llm import notices
from faremill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@functools.cache
def finder():
    return notices.NoticeFinder(notices.NOTICES, notices.CHARS_PER_ERROR)


def labels(text):
    return sorted({f[0] for f in finder().find(text)})


def distance(a, b, most):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        if min(now) > most:
            return most + 1
        before = now
    return before[-1]


def plain_find(text):
    """(label, errors) of the notices, the best of those that overlap first."""
    words, found = text.split(), []
    for label, notice, keys in notices.NOTICES:
        most, size = len(notice) // notices.CHARS_PER_ERROR, len(notice.split())
        for low in range(len(words)):
            for high in range(low + max(1, size - 3), min(len(words), low + size + 3) + 1):
                own = words[low:high]
                rest = iter(own)
                if abs(len(" ".join(own)) - len(notice)) > most or not all(k in rest for k in keys):
                    continue
                telling = lambda ws, commons="cc" in keys: [w for w in ws if w.isdigit() or commons and w in ("by", "sa", "nd", "nc")]
                behind = words[high : high + 1]
                if telling(own) != telling(notice.split()) or behind and (notice.split()[-1].isdigit() and behind[0].isdigit() or "cc" in keys and behind[0] in ("by", "sa", "nd", "nc")):
                    continue
                errors = distance(notice, " ".join(own), most)
                if errors <= most:
                    found.append((errors / len(notice), -len(" ".join(own)), low, high, label, errors))
    taken, out = [], []
    for _, _, low, high, label, errors in sorted(found):
        if all(high <= a or low >= b for a, b in taken):
            taken.append((low, high))
            out.append((label, errors))
    return sorted(out)


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("abz ") + text[at:], text[:at] + rng.choice("abz") + text[at + 1 :]])
    return " ".join(text.split())


def test_edited_notices_equal_a_scan_of_all_windows():
    rng, found = random.Random(12), 0
    for notice in notices.NOTICES * 2:
        text = edited(rng, notice[1], rng.randint(0, len(notice[1]) // 12))
        around = [" ".join(rng.choice(["alpha", "beta", "the", "under", "2", "license", "sa"]) for _ in range(rng.randint(0, 3))) for _ in range(2)]
        whole = " ".join(f"{around[0]} {text} {around[1]}".split())
        got, want = sorted((f[0], f[3]) for f in finder().find(whole)), plain_find(whole)
        assert got == want, (whole, got, want)
        found += len(want)
    assert found > len(notices.NOTICES)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("released under the mpl license", ["mpl"]), ("released under the bsl license", ["bsl"]), ("under the foo license", []),
        ("licensed under the gnu general public license version 1", ["gpl-1"]), ("gnu general public license version 2 or later", ["gpl-2"]),
        ("the gnu lesser general public license version 2 1", ["lgpl-2.1"]), ("gnu lesser general public license version 2 2", []),
        ("apache license version 1 1", ["apache-1.1"]), ("apache license version 2 0", ["apache-2"]), ("apache license version 12", []),
        ("mozilla public license v 1 1", ["mpl-1.1"]), ("mozilla public license v 2 0", ["mpl-2"]), ("small rights reserved", []), ("all rights reserved", ["all-rights-reserved"]),
        ("licensed under cc by nc sa 4 0", ["cc-by-nc-sa"]), ("licensed under cc by nc 4 0", ["cc-by-nc"]), ("licensed under cc by 4 0", ["cc-by"]),
        ("released undr the mit licence", ["mit"]), ("gnu general public licence version 3", ["gpl-3"]), ("", []), ("a", []),
    ],
)
def test_licences_are_told_apart(text, want):
    assert labels(text) == want


def test_query_equals_a_plain_version(spark):
    """Base columns by plain search of words, the method's labels by the finder that the scan of windows confirms."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op7_fuzzy_notices"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    for doc, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(w, label) for phrase, label in notices.PHRASES.items() for p in [phrase.split()] for w in range(len(words) - len(p) + 1) if words[w : w + len(p)] == p]
        r = got[doc]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted({x for _, x in places})))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.labels == ",".join(sorted({x for _, x in places} | {*labels(" ".join(words))}))
