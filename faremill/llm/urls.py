"""URLs judged by rules, and where no rule fits by naive Bayes over the words of host and path.

Host names run words together. A name is split by the most probable sequence of words under a unigram model (Viterbi); the
words' frequencies come from the corpus and from names that are written apart. A multinomial naive Bayes over the words of host and path
then weighs block against allow. It learns from the URLs themselves: those whose host has a listed word are examples of what
to block, the others of what to allow, so it also knows the words that keep company with the listed ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.scratch import Scratch
from faremill.llm.texts import slices, span_hashes, table, words

# The rules, as host/path.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

# Words that a site to be blocked has in its name.
LISTED = (
    "adult", "ads", "bet", "bets", "betting", "bingo", "casino", "casinos", "escort", "escorts", "gambling", "jackpot", "malware", "nude", "nudes", "phishing",
    "pharmacy", "pills", "piracy", "poker", "porn", "porno", "roulette", "scam", "sex", "sexy", "slots", "spam", "tracker", "tracking", "viagra",
    "warez", "xxx",
)

# Ordinary words of names, which a corpus may lack.
COMMON = (
    "best", "blog", "book", "books", "buy", "cheap", "city", "club", "cloud", "data", "day", "deal", "deals", "farm", "food", "free", "game", "games",
    "garden", "health", "home", "house", "info", "life", "mail", "market", "media", "money", "music", "news", "online", "photo", "play", "room", "school", "search", "shop",
    "sport", "sports", "store", "tech", "times", "town", "track", "travel", "video", "web", "win", "world",
)

#: The longest word that a name is split into, the shortest that counts, and what a vocabulary holds at most.
LONGEST, SHORTEST, VOCABULARY = 24, 2, 50_000
#: What a listed or ordinary word counts for at least, as a share of all words.
LISTED_SHARE = 1e-5
#: Words that each class is taken to have had already, spread over the words as in all hosts.
PRIOR_WORDS = 20.0
#: Names kept split by a task, and words counted by it, before it begins anew.
KEPT = 100_000
RUN = re.compile(r"[^\W\d_]+")
PLAIN = re.compile(r"[a-z]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host in lower case, after the first "://" up to "/", "?", "#" or the end, and path, from there up to "?", "#" or the end."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = re.split("[?#]", url[at + 3 :], maxsplit=1)[0]
    cut = rest.find("/")
    return (rest.translate(LOWER), "") if cut < 0 else (rest[:cut].translate(LOWER), rest[cut:])


class Rules:
    """Rules by host; the longest that fits wins, of equally long ones that with the longer host."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules:
            cut = rule.find("/")
            host = rule[:cut].translate(LOWER)
            self.by_host.setdefault(host, []).append((rule[cut:], rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of a host, itself or a subdomain of the rule's, whose path starts with the rule's."""
        best, at = None, 0
        while True:
            for start, rule, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            dot = host.find(".", at)
            if dot < 0:
                return best
            at = dot + 1


class Splitter:
    """The most probable words of a name, by Viterbi under a unigram model; ties to fewer, then longer first words.

    A word that the model lacks costs what ten words of one count cost, tenfold for each letter, so letters without a known word stay together.
    """

    def __init__(self, counts: dict[str, float]):
        total = math.log(sum(counts.values()) or 1)
        self.cost = {w: total - math.log(c) for w, c in counts.items() if c > 0 and PLAIN.fullmatch(w) and len(w) <= LONGEST}
        self.unknown = [total - math.log(10) + n * math.log(10) for n in range(LONGEST + 1)]
        self.kept: dict[str, tuple[str, ...]] = {}

    def split(self, name: str) -> tuple[str, ...]:
        """The words of a run of letters; a run with others than a-z is one word."""
        found = self.kept.get(name)
        if found is None:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            found = self._split(name) if PLAIN.fullmatch(name) else (name,)
            if len(name) <= 256:
                self.kept[name] = found
        return found

    def _split(self, name: str) -> tuple[str, ...]:
        best, back = [(0.0, 0)], [0]
        for end in range(1, len(name) + 1):
            options = []
            for size in range(1, min(LONGEST, end) + 1):
                cost, n = best[end - size]
                options.append((cost + self.cost.get(name[end - size : end], self.unknown[size]), n + 1, size))
            cost, n, size = min(options)
            best.append((cost, n))
            back.append(size)
        out, end = [], len(name)
        while end:
            out.append(name[end - back[end] : end])
            end -= back[end]
        return tuple(reversed(out))

    def words(self, text: str) -> list[str]:
        """The words of a host or path, single letters left out. What isn't a letter separates names and is no word itself."""
        return [w for run in RUN.findall(text.lower()) for w in self.split(run) if len(w) >= SHORTEST]


@dataclass(frozen=True)
class UrlModel:
    """Counts for the splitter, and each word's log-odds of block against allow with those of no word."""

    unigrams: dict[str, float]
    odds: dict[str, float]
    prior: float

    def splitter(self) -> Splitter:
        return Splitter(self.unigrams)

    def score(self, found: list[str]) -> float:
        """The probability of block."""
        total = self.prior + sum(self.odds.get(w, 0.0) for w in found)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of letters a-z in all texts, in lower case, of 2 to 24 letters. Words that touch a digit or another letter are none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        breaks = table(*(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122 or b == 95)))
        plain = np.zeros(256, bool)
        plain[97:123] = True
        held: dict[bytes, int] = {}

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for _, data, starts in slices(batch.column(0)):
                text, begin, end, _ = words(data, starts, breaks)
                odd = np.concatenate([[0], np.cumsum(~plain[text])])
                ok = (odd[end] == odd[begin]) & (end - begin >= SHORTEST) & (end - begin <= LONGEST)
                begin, end = begin[ok], end[ok]
                _, first, times = np.unique(span_hashes(text, begin, end), return_index=True, return_counts=True)
                whole = text.tobytes()
                for b, e, n in zip(begin[first].tolist(), end[first].tolist(), times.tolist(), strict=True):
                    held[whole[b:e]] = held.get(whole[b:e], 0) + n
                if len(held) >= KEPT:
                    yield told()
        yield told()

    found = docs.select(F.col("text").cast("string")).where("text IS NOT NULL").mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, size: int, scratch: Scratch, name: str) -> list:
    """The rows of the words that are frequent enough for no more than `size` to be so: (word, n, ...), by column n.

    Counts fall into classes of an eighth of a power of two, at most 512 of which there are; the least class goes that would bring the rows over the size.
    """
    kept = scratch.keep(counts.withColumn("class", F.floor(8 * F.log2("n")).cast("int")), name)
    left, least = size, None
    for row in kept.groupBy("class").agg(F.count("*").alias("rows")).orderBy(F.desc("class")).collect():
        left -= row["rows"]
        if left < 0:
            break
        least = row["class"]
    return [] if least is None else kept.where(F.col("class") >= least).drop("class").collect()


def _counted(urls: DataFrame, schema: str, read: Callable[[str, str], Iterable[tuple]]) -> DataFrame:
    """What `read` finds in host and path of each URL, added up within tasks: (key..., n)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            columns = list(zip(*(k for k in held), strict=True)) or [()] * schema.count(",")
            out = pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(list(held.values()), pa.int64())], [c.split()[0] for c in schema.split(", ")])
            held.clear()
            return out

        for batch in batches:
            for url in batch.column(0).to_pylist():
                held.update(read(*host_and_path(url)))
                if len(held) >= KEPT:
                    yield told()
        yield told()

    keys = [c.split()[0] for c in schema.split(", ")[:-1]]
    return urls.mapInArrow(counted, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def _written_apart(host: str, path: str) -> Iterable[tuple[str]]:
    """Words that a name's owner has written apart."""
    for part in re.split("[./]", f"{host}{path}".lower()):
        runs = re.split("[-_+]", part)
        if len(runs) > 1:
            yield from ((r,) for r in runs if PLAIN.fullmatch(r) and SHORTEST <= len(r) <= LONGEST)


def fit(pages: DataFrame, corpus: DataFrame, listed: Iterable[str] = LISTED, vocabulary: int = VOCABULARY) -> UrlModel:
    """A model from all URLs of `pages` and all texts of `corpus`.

    All are counted; the model holds at most `vocabulary` words for the splitter and as many for naive Bayes, the most frequent ones, and
    always those listed. A host is one example, whatever its number of URLs: each word of its name and of its paths counts
    once. Each listed word is one more example of what to block, each ordinary one of what to allow.
    """
    scratch = Scratch(pages.sparkSession)
    urls, listed = pages.select(F.col("url").cast("string")), frozenset(listed)
    unigrams: dict[str, float] = {r["word"]: float(r["n"]) for r in most_frequent(count_words(corpus), vocabulary, scratch, "words")}
    apart = most_frequent(_counted(urls, "word string, n long", _written_apart), vocabulary, scratch, "apart")
    # A hot name must not outweigh the corpus: it counts by the logarithm of its URLs.
    for r in apart:
        unigrams[r["word"]] = unigrams.get(r["word"], 0.0) + 1 + math.log(r["n"])
    least = max(1.0, LISTED_SHARE * sum(unigrams.values()))
    for word in (*listed, *COMMON):
        unigrams[word] = max(unigrams.get(word, 0.0), least)
    splitter = Splitter(unigrams)

    def classed(host: str, path: str) -> Iterable[tuple[str, str, str]]:
        of_host = splitter.words(host)
        kind = "block" if listed.intersection(of_host) else "allow"
        # The empty word counts the hosts.
        return {(host, w, kind) for w in (*of_host, *splitter.words(path), "")} if host else ()

    examples = _counted(urls, "host string, word string, kind string, n long", classed)
    by_kind = [F.sum((F.col("kind") == kind).cast("long")).alias(kind) for kind in ("block", "allow")]
    by_word = scratch.keep(examples.groupBy("word").agg(*by_kind, F.count("*").alias("n")), "classed")
    total = by_word.where("word <> ''").agg(*(F.sum(c).alias(c) for c in ("block", "allow"))).first()
    hosts = by_word.where("word = ''").first()
    own = {r["word"]: [r["block"], r["allow"]] for r in most_frequent(by_word.where("word <> ''"), vocabulary, scratch, "scored")}
    for kind, extra in enumerate((listed, frozenset(COMMON) - listed)):
        for word in extra:
            own.setdefault(word, [0, 0])[kind] += 1
    sizes = [(total["block"] or 0) + len(listed), (total["allow"] or 0) + len(frozenset(COMMON) - listed)]
    odds = {}
    for word, counts in own.items():
        share = sum(counts) / sum(sizes)
        block, allow = ((n + PRIOR_WORDS * share) / (size + PRIOR_WORDS) for n, size in zip(counts, sizes, strict=True))
        odds[word] = math.log(block / allow)
    blocked, allowed = (hosts["block"], hosts["allow"]) if hosts else (0, 0)
    return UrlModel(unigrams, odds, math.log((blocked + 1) / (allowed + 1)))


def judge(pages: DataFrame, model: UrlModel, rules: Iterable[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words) of every row.

    rule is the longest rule that fits host and path, or NULL, verdict the rule's or else the model's: block where score, the probability
    of that by naive Bayes, is over one half. words are those it is scored by. A URL that is NULL or has no "://" has an empty host and path,
    no rule and no words, and is judged by the classes' sizes alone. Rows are judged one by one, repeated ones alike. Columns other than page_id and
    url are not read.
    """
    rules = tuple(rules)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, known = model.splitter(), Rules(rules)
        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = host_and_path(url)
                rule = known.find(host, path) if host else None
                found = [*splitter.words(host), *splitter.words(path)]
                score = model.score(found)
                rows.append((host, path, rule and rule[0], rule[1] if rule else "block" if score > 0.5 else "allow", score, found))
            types = [pa.string()] * 4 + [pa.float64(), pa.list_(pa.string())]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 6, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["page_id", "host", "path", "rule", "verdict", "score", "words"])

    asked = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    return asked.mapInArrow(judged, "page_id long, host string, path string, rule string, verdict string, score double, words array<string>")
