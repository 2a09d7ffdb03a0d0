"""Lexical search, URL judgements and tokenizer alignment against plain versions, on tables with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from faremill.llm import alignment, lexical, urls
from faremill.llm.queries import QUERIES
from faremill.llm.scratch import Scratch

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RANKS, MODEL = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, m long, share long, terms string, n long, docs long, item string, chunk long, kind int, place long, pair long, best boolean"


def padded(rows):
    """Rows with clashing columns, which nothing may read."""
    return [(i, t, 5, 5, "x", 5, 5, "x", 5, 5, 5, 5, True) for i, t in rows]


# --- lexical search -------------------------------------------------------------------------------------------------


def plain_ranks(docs, items, k):
    terms = lambda text: TERM.findall((text or "").translate(LOWER))
    own = [(i, collections.Counter(terms(t))) for i, t in docs if i is not None and terms(t)]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = collections.Counter(t for _, c in own for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, c in own:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def lexical_rows():
    rng = random.Random(4)
    word = lambda: rng.choice(["alpha", "Beta", "GAMMA", "δέλτα", "É", "x9", "the", "the", "the"]) + rng.choice(["", "", str(rng.randint(0, 60))])
    texts = [None, "", " .,;- \x00", "the", "THE the", "the " * 500, " ".join(word() for _ in range(30_000)), *["alpha beta, gamma"] * 7]
    texts += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(300)]
    docs = [(i * 2 - 3, t) for i, t in enumerate(texts)]
    rng.shuffle(docs)
    docs += [docs[0], docs[1], (None, "alpha without an id")]
    items = [(1, "alpha, BETA alpha"), (2, "the"), (3, "no such word"), (4, None), (5, ""), (6, "δέλτα7 É x9"), (6, "gamma3"), (7, texts[20]), (7, texts[20]), (None, "alpha"), (8, "alpha beta gamma")]
    return docs, items


def test_ranks_equal_a_plain_version(spark, lexical_rows):
    docs, items = lexical_rows
    table = spark.createDataFrame(padded(docs), SCHEMA).repartition(5)
    asked = spark.createDataFrame([(i, t, 3, 4) for i, t in items], "item_id long, text string, term long, doc_id long")
    for k in (1, 10, 1000):
        got = lexical.top_documents(table, asked, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(tuple(r) for r in got.collect()) == plain_ranks(docs, items, k)


def test_small_units_shares_blocks_and_rounds_change_nothing(spark, lexical_rows, monkeypatch):
    docs, items = lexical_rows
    for name, value in (("UNIT_POSTINGS", 40), ("UNIT_DOCS", 3), ("SHARE_DOCS", 4), ("ITEM_BYTES", 64), ("CELLS", 7), ("EXACT", 0)):
        monkeypatch.setattr(lexical, name, value)
    got = lexical.top_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 10)
    assert sorted(tuple(r) for r in got.collect()) == plain_ranks(docs, items, 10)


def test_ranks_of_empty_tables(spark, lexical_rows):
    docs, items = (spark.createDataFrame(x, s) for x, s in zip(lexical_rows, ("doc_id long, text string", "item_id long, text string"), strict=True))
    assert lexical.top_documents(docs.limit(0), items).count() == 0
    assert lexical.top_documents(docs, items.limit(0)).count() == 0
    assert lexical.top_documents(docs.where("text IS NULL"), items).count() == 0


def test_a_threshold_spares_most_units(spark, monkeypatch):
    """Where an item's words are in a few documents, the units without them are visited by no round."""
    rng = random.Random(1)
    docs = [(i, " ".join(f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(5, 200)))) for i in range(2000)]
    docs += [(5000 + i, f"needle{i % 3} hay pin " + " ".join(f"w{rng.randint(0, 3000)}" for _ in range(30))) for i in range(40)]
    scratch = Scratch(spark)
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"), scratch)
    asked = lexical._Asked([(1, int(h)) for _, hashes, _ in lexical._term_hashes(lexical.pa.array(["needle0 hay pin w7 w8"])) for h in hashes.view(np.int64)])
    asked.weigh(lexical._frequencies(index, asked), index.documents)
    bounds = lexical._stratum_bounds(index, asked).collect()
    got = lexical.search(index, spark.createDataFrame([(1, "needle0 hay pin w7 w8")], "item_id long, text string"), scratch).collect()
    least = min(r.score for r in got)
    assert len(got) == 10 and sum(r.docs for r in bounds if r.bound >= least) < 0.2 * index.documents


# --- URL filters ----------------------------------------------------------------------------------------------------

PLAIN_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain_url(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in PLAIN_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


ODD_URLS = [
    None, "", "no scheme", "http://", "://", "http://NET/x", "http://net", "http://net?x/", "http://a.net/?q", "http://anet/", "http://www.Example.net/en/1", "http://www.example.net/en",
    "http://example.net/EN/", "http://badexample.net/en/", "http://example.com/de/x?y=/fr/", "http://example.com#/de/", "http://x.org/fr/1", "http://org/fr/", "ftp://x.org/fr", "http://a//b://c/d",
    "http://user@x.net:80/", "http://x.net./", "http://.net/", "http://net/\n/en/", "http://é.net/ü", "http://" + "a" * 100_000 + ".org/" + "b" * 100_000,
]


def test_hosts_paths_and_rules_equal_a_plain_version(spark):
    rows = [(i, u, "x", 1.0, "h") for i, u in enumerate(ODD_URLS)] + [(None, "http://a.net/", None, None, None), (3, "http://a.net/", "", 0.0, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, word string, score double, host string")
    corpus = spark.createDataFrame([(1, "some words of a text"), (2, None)], "doc_id long, text string")
    got = urls.judge(pages, urls.fit(pages, corpus)).collect()
    assert len(got) == len(rows)
    want = collections.Counter((i, *plain_url(u)) for i, u, *_ in rows)
    assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got) == want
    assert {r.verdict for r in got} <= {"block", "allow"} and all(0 <= r.score <= 1 for r in got)


def test_the_longest_rule_wins():
    rng = random.Random(2)
    hosts, paths = ["c", "b.c", "a.b.c", "xb.c"], ["/", "/a", "/a/", "/a/b"]
    rules = [(h + p, rng.choice(["block", "allow"])) for h in hosts for p in paths if rng.random() < 0.6]
    known = urls.Rules(rules)
    for host, path in itertools.product([*hosts, "z.a.b.c", "c.z", ""], ["", *paths, "/ab"]):
        fits = [r for r in rules if (h := r[0][: r[0].index("/")]) and (host == h or host.endswith("." + h)) and path.startswith(r[0][len(h) :])]
        found = known.find(host, path)
        assert (found is None) == (not fits) and (not fits or len(found[0]) == max(len(r[0]) for r in fits) and found in fits)


def test_names_are_split_into_the_most_probable_words():
    rng = random.Random(3)
    counts = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))): rng.randint(1, 1000) for _ in range(25)}
    splitter = urls.Splitter(counts)

    def cost(parts):
        return sum(splitter.cost.get(p, splitter.unknown[len(p)]) for p in parts)

    for _ in range(100):
        name = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        cuts = (list(c) for n in range(len(name)) for c in itertools.combinations(range(1, len(name)), n))
        best = min(cost([name[a:b] for a, b in itertools.pairwise([0, *c, len(name)])]) for c in cuts)
        found = splitter.split(name)
        assert "".join(found) == name and math.isclose(cost(found), best)
    long = "abc" * 50_000
    assert "".join(splitter.split(long)) == long


def test_words_run_together_are_judged_like_those_written_apart(spark):
    good = ["garden-times", "book-club", "city-news", "music-school", "travel-blog", "health-info"]
    bad = ["casino-win", "free-bets", "adult-x"]
    rows = [f"https://www.{h}.example.org/en/{n}" for h in good * 3 + bad for n in range(20)]
    rows += [f"https://{h}.example.org/en/1" for h in ("freecasino", "winbets", "gardennews", "freebooks", "cityclub", "moviehouse")]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    corpus = spark.createDataFrame([(1, "the garden was free and the house of a movie stood in the city " * 50)], "doc_id long, text string")
    got = {r.host.removeprefix("www.").split(".")[0]: r for r in urls.judge(pages, urls.fit(pages, corpus)).collect()}
    assert {h for h, r in got.items() if r.verdict == "block"} == {*bad, "freecasino", "winbets"}
    assert got["freecasino"].words[:2] == ["free", "casino"] and got["moviehouse"].words[:2] == ["movie", "house"]


def test_odds_equal_a_plain_count_by_host(spark):
    rows = ["http://bet-shop.org/win", "http://bet-shop.org/win", "http://bet-shop.org/lose", "http://book-shop.org/lose", "http://casino.org/", "http://town.org/a/shop"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    model = urls.fit(pages, spark.createDataFrame([], "doc_id long, text string"))
    words = {"bet-shop.org": "bet shop org win lose", "book-shop.org": "book shop org lose", "casino.org": "casino org", "town.org": "town org shop"}
    counts = collections.defaultdict(lambda: [0, 0])
    for host, found in words.items():
        for w in found.split():
            counts[w]["bet" not in host and "casino" not in host] += 1
    sizes = [sum(c[i] for c in counts.values()) for i in (0, 1)]
    for i, extra in ((0, set(urls.LISTED)), (1, set(urls.COMMON) - set(urls.LISTED))):
        for w in extra:
            counts[w][i] += 1
        sizes[i] += len(extra)
    want = {}
    for w, c in counts.items():
        share = sum(c) / sum(sizes)
        want[w] = math.log((c[0] + urls.PRIOR_WORDS * share) / (sizes[0] + urls.PRIOR_WORDS) / ((c[1] + urls.PRIOR_WORDS * share) / (sizes[1] + urls.PRIOR_WORDS)))
    assert model.odds.keys() == want.keys() and all(math.isclose(model.odds[w], x) for w, x in want.items())
    assert math.isclose(model.prior, math.log(3 / 3))


def test_words_of_a_corpus_are_counted_whole(spark):
    texts = ["The the THE, x-ray über naïve b2b snake_case under", None, "", "the " * 10_000 + "z" * 25 + " " + "y" * 24]
    got = {r.word: r.n for r in urls.count_words(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got == {"the": 10_003, "ray": 1, "under": 1, "y" * 24: 1}


def test_a_vocabulary_keeps_whole_classes_of_counts(spark):
    rows = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate([1000, 500, 499, 3, 3, 3, 1, 1])], "word string, n long")
    for size, want in ((0, 0), (1, 1), (2, 1), (3, 3), (5, 3), (6, 6), (7, 6), (8, 8)):
        assert len(urls.most_frequent(rows, size, Scratch(spark), "w")) == want


def test_url_query_on_the_smallest_tables(spark):
    got = QUERIES["op12_host_words"](spark, SF_DIR).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(got) == len(pages)
    # The names of sites that the tables' makers mean to be blocked.
    bad = re.compile(r"adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm")
    for r in got:
        host, path, rule, verdict = plain_url(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if bad.search(host) else "allow"))


# --- alignment ------------------------------------------------------------------------------------------------------


def plain_alignment(rows):
    """Each text encoded whole by both libraries, ends intersected as sets, links counted one by one."""
    a_of = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    a_bytes = {i: bytes(shown[c] for c in t) for t, i in a_of.get_vocab().items() if t != "<|endoftext|>"}
    b_bytes = lambda i: bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x(..)>", p := b_of.id_to_piece(i))) else p.replace("▁", " ").encode()
    found, held = [], collections.Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            found.append((doc, [], [], []))
            continue
        ends = [list(itertools.accumulate(len(x) for x in side)) for side in ([a_bytes[i] for i in a], [b_bytes(i) for i in b])]
        groups, at = [], [0, 0]
        for end in sorted({*ends[0]} & {*ends[1]}):
            now = [ends[s].index(end, at[s]) + 1 for s in (0, 1)]
            groups.append((a[at[0] : now[0]], b[at[1] : now[1]]))
            at = now
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.update({*links})
        found.append((doc, (a, b), groups, links))
    best = collections.Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for doc, ids, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if ids else ""
        sizes = (len(ids[0]), len(ids[1])) if ids else (0, 0)
        out.append((doc, *sizes, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), sha))
    return out, held, best


def as_key(row):
    return tuple((x is None, x) for x in row)


@pytest.fixture(scope="module")
def aligned_rows():
    rng = random.Random(6)
    parts = ["a", "b ", " c", "\n", "\t", " \n ", "  ", "é", "e\u0301", "中文", "😀", "l'", "<|endoftext|>", "<s>", "<0x0A>", "</s>", "\x00", "\x1c ", "\u2028 ", "\xa0 ", " \u3000", "１２", "ﬁ", "__", "\u200b", "word", " the", "123456", "..."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    texts += [None, "", " ", "  ", "\n", "▁", "a▁b", "a ▁ b", "same text here", "same text here", " lead", "trail ", "x" * 700, " " * 3000, "ab" * 500, "é" * 600, "a " * 500, "=" * 200 + " " + "-" * 200, "one\u2581two three"]
    return [(i if i % 50 else None, t) for i, t in enumerate(texts)]


def test_alignment_equals_a_plain_version(spark, aligned_rows):
    want, held, best = plain_alignment(aligned_rows)
    table = spark.createDataFrame(padded(aligned_rows), SCHEMA).repartition(5)
    found = alignment.Alignment(table, RANKS, MODEL)
    got = found.documents()
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=as_key) == sorted(want, key=as_key)
    assert {(r.a, r.b): (r.docs, r.best) for r in found.pairs().collect()} == {p: (n, n == best[p[0]]) for p, n in held.items()}
    assert alignment.align_documents(table.limit(0), RANKS, MODEL).count() == 0


def test_small_chunks_and_counted_groups_change_nothing(spark, aligned_rows, monkeypatch):
    rows = aligned_rows[:40] + aligned_rows[-20:]
    want, *_ = plain_alignment(rows)
    for name, value in (("CHUNK", 50), ("KEPT", 3), ("LISTED", 1)):
        monkeypatch.setattr(alignment, name, value)
    got = alignment.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, MODEL)
    assert sorted((tuple(r) for r in got.collect()), key=as_key) == sorted(want, key=as_key)


def test_alignment_query_on_the_smallest_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_galloping_alignment"](spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_alignment(rows)[0])


def test_gallop_finds_every_place():
    rng = np.random.default_rng(1)
    for _ in range(200):
        parts = [np.unique(rng.integers(0, 60, rng.integers(0, 30))) for _ in range(4)]
        long, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        row = rng.integers(0, 4, 50)
        short, at = rng.integers(-2, 62, 50), rng.integers(-5, len(long) + 5, 50)
        got = alignment.gallop(short, long, bounds[row], bounds[row + 1], at)
        assert (got == [bounds[r] + np.searchsorted(parts[r], s) for r, s in zip(row, short, strict=True)]).all()


def test_very_long_texts_are_aligned(spark):
    text = "word " * 300_000 + "x" * 100_000 + " " * 100_000 + "end"
    (got,) = alignment.align_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, MODEL).collect()
    assert got.n_groups >= 300_001 and got.n_links >= got.n_groups and got.count_sum == got.n_links
