"""Invalid vectors, bounds that prune, and personal data of any length and spelling."""

from __future__ import annotations

import datetime
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import knn, pseudonyms
from faremill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
KEY = "a key for the test tables"


def plain_top(rows, k=10, every=100):
    whole = {i: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v] for i, v in rows if v is not None and None not in v and np.isfinite(v).all()}
    want = set()
    for q in whole:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)[:k]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return want


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x", 0.0, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int, kind string, away double, rank int").repartition(3)


def test_invalid_vectors_are_no_queries_and_no_candidates(spark):
    nan, inf = float("nan"), float("inf")
    valid = [(0, [1.0, 2.0]), (200, [-1.0, 0.5]), (3, [0.25, 0.25]), (4, [-3.0, -3.0])]
    invalid = [(100, [1.0, nan]), (300, [inf, 1.0]), (400, [-inf, -1.0]), (500, None), (600, [None, 1.0]), (700, [None, None]), (5, [nan, 9.0]), (6, [9.0, inf]), (7, None), (8, [None, 9.0])]
    got = {tuple(r) for r in knn.top_k(frame(spark, valid + invalid), F.col("vec_id") % 100 == 0).collect()}
    assert got == plain_top(valid) and {g[0] for g in got} == {0, 200} and len(got) == 6
    assert knn.top_k(frame(spark, invalid), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("size", [1, 9, 10, 11, 12, 300])
def test_few_and_many_rows_equal_brute_force(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i * 20, [float(x) for x in rng.normal(size=4).astype("f4")]) for i in range(size)] + [(7, [0.0] * 4)]
    assert {tuple(r) for r in knn.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()} == plain_top(rows)


def test_clustered_vectors_are_sent_to_few_cells(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 24)) * 8
    rows = [(i, [float(x) for x in (centres[i % 40] + rng.normal(size=24) * 0.05).astype("f4")]) for i in range(4000)]
    df = frame(spark, rows)
    join = knn.VoronoiJoin(df, F.col("vec_id") % 100 == 0, 10, "vec_id", "embedding")
    first = join.scratch.keep(join.best(join.solved(join.first_sent())), "first")
    sent = join.rest_sent(first).select("cell", "vec_id").distinct().count()
    assert sent < 0.05 * 40 * len(join.radius)
    assert {tuple(r) for r in knn.top_k(df, F.col("vec_id") % 100 == 0).collect()} == plain_top(rows)


# --- pseudonyms -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def worker():
    return pseudonyms.Pseudonymizer(KEY.encode())


def moved(worker, text):
    out, at = [], 0
    for _, begin, end, other in worker.spans(text):
        out += [text[at:begin], other]
        at = end
    return "".join([*out, text[at:]])


@pytest.mark.parametrize("n", [65, 3000, 4000, 10_000, 1_000_000])
@pytest.mark.parametrize("letters", ["a", "7", "aB3"])
def test_addresses_of_any_length(worker, n, letters):
    name = (letters * n)[:n]
    got = moved(worker, f"to {name}@b.com now")
    local = re.fullmatch(r"to (\S+)@b\.com now", got)[1]
    kinds = str.maketrans("0123456789", "9" * 10) if n < 10**6 else None
    assert len(local) == n and local != name
    if kinds:
        shape = lambda text: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", text.translate(kinds)))
        assert shape(local) == shape(name)


def test_runs_of_digits_and_groups_of_any_length(worker):
    for text in ("1" * 10**6, "1 " * 20_000, "ab." * 10**5 + "@b.com", "token = " * 10**4):
        assert len(moved(worker, text)) == len(text)


def test_wide_values_are_permuted(worker):
    """Short parts make the chain's format small enough to move every value of it."""
    sizes = [5, 4, 3]
    every = [[a, b, c] for a in range(5) for b in range(4) for c in range(3)]
    for tweak in ("one", "two"):
        assert len({tuple(pseudonyms._chained(worker.feistel, v, sizes, tweak)) for v in every}) == len(every)
    rng, seen = random.Random(4), {}
    for _ in range(200):
        name = "".join(rng.choice("ab") for _ in range(70))
        other = moved(worker, f"{name}@b.com")
        assert seen.setdefault(other, name) == name


def test_a_change_of_one_letter_changes_every_part(worker):
    a, b = (moved(worker, f"{'x' * 100}{c}{'x' * 100}@b.com") for c in "xy")
    assert all(a[i : i + 64] != b[i : i + 64] for i in (0, 64, 128))


def test_a_day_has_one_pseudonym_in_every_form(worker):
    rng, seen = random.Random(9), {}
    for _ in range(400):
        day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(pseudonyms.DAYS))
        forms = ["%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y"] + ["%m/%d/%Y"] * (day.day > 12)
        got = {datetime.datetime.strptime(moved(worker, day.strftime(f)), f).date() for f in forms}
        assert len(got) == 1
        (other,) = got
        assert (other.day > 12) == (day.day > 12) and seen.setdefault(other, day) == day
    assert moved(worker, "2020-01-13 13/01/2020 13.01.2020 01/13/2020") == "1925-07-15 15/07/1925 15.07.1925 07/15/1925"


@pytest.mark.parametrize(
    "shape", ['password="{}"', "token = '{}'", 'key: "{}"', "secret={}", '"password": "{}"', "PWD={}", 'api_key ="{}"', "passwd: {} "]
)
@pytest.mark.parametrize("value", ["0123456789abcdef", "0123456789ABCDEF01", "AKIA1234abcd5678XYZ", "abcdefabcdefabcdef"])
def test_secrets_in_the_usual_spellings(worker, shape, value):
    text = shape.format(value)
    got = moved(worker, text)
    assert value not in got and len(got) == len(text) and got.startswith(shape.split("{")[0])


def test_words_after_a_name_are_no_secret(worker):
    for text in ("the key: internationalization", "password = unbelievablylongword", "monkey 0123456789abcdef", "token 0123456789abcdef"):
        assert moved(worker, text) == text


def test_check_digits_that_no_iban_has_stay(worker):
    body = "120300000000202051"
    digits = 98 - pseudonyms._iban_remainder("DE00" + body)
    assert moved(worker, f"DE{digits:02d}{body}") != f"DE{digits:02d}{body}"
    for wrong in (digits - 97, digits + 97):
        if 0 <= wrong <= 99:
            assert moved(worker, f"DE{wrong:02d}{body}") == f"DE{wrong:02d}{body}"


def test_query_keeps_formats_links_and_everything_else(spark):
    """Against a plain version: what each span was is of its kind, what it became too, equal values became equal, and the rest is as it was."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    bare = lambda text: re.sub(r"[ ().-]", "", text)
    forward, back, kinds = {}, {}, set()
    for r in QUERIES["op2_feistel_pseudonyms"](spark, SF_DIR).collect():
        text, out, at = texts[r.doc_id], [], 0
        assert r.n_replaced == len(r.spans)
        for s in r.spans:
            assert s.begin >= at
            was = text[s.begin : s.end]
            out += [text[at : s.begin], s.pseudonym]
            at = s.end
            kinds.add(s.kind)
            assert re.sub("[A-Z]", "A", re.sub("[a-z0-9]", "a", was)) == re.sub("[A-Z]", "A", re.sub("[a-z0-9]", "a", s.pseudonym)) or s.kind in ("ipv4", "secret")
            if s.kind in ("card", "iban", "ssn", "email", "ipv4"):
                assert forward.setdefault((s.kind, bare(was)), bare(s.pseudonym)) == bare(s.pseudonym)
                assert back.setdefault((s.kind, bare(s.pseudonym)), bare(was)) == bare(was)
        assert r.text == "".join([*out, text[at:]])
    assert {"email"} <= kinds
    whole = "\n".join(texts.values())
    for kind in ("email", "ipv4"):
        # Found by another, plainer pattern: all valid ones were moved.
        plain = re.findall(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", whole) if kind == "email" else re.findall(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])", whole)
        assert {bare(p.rstrip(".")) for p in plain if kind == "email" or max(map(int, p.split("."))) < 256} <= {v for k, v in forward if k == kind}
