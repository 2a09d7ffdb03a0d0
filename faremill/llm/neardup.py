"""Near-duplicate documents by MinHash with tensored banding.

A document's set is its distinct n-word shingles. Instead of hashing every set once for each row
of each band, `groups` small collections of `width` minhashes are computed; a table's key is a pair
of collections, so 18 x 3 evaluations serve 153 tables of 6 rows. Two documents of similarity s agree in a
collection with probability s^width, and meet in a table when they agree in two of them: at 0.8
all but 5 in 100,000 pairs do, at 0.85 all but 1 in 1,000,000. What meets is verified on whole sets.

Equal sets are one class from the start. In every table the class with the smallest document is the
hub that the others are verified against: a row for each member, never all pairs. Components
of those links leave open only the tables whose members lie in different components. The members of
these are dealt into chunks of bounded size, near ones together, and two chunks become a unit if a table holds a pair
between components that agrees often enough to be near. A unit's whole texts meet in one task, which verifies its
pairs and returns a spanning forest of links: a row for each member at most, however many pairs there are.
Texts travel compressed, and sets, which are larger, are made where they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.components import connected_components
from faremill.llm.scratch import Scratch
from faremill.llm.texts import BASE, mix, shingle_sets, slices

GROUPS, WIDTH = 18, 3
#: Of 54 minhashes, two sets of similarity 0.8 agree in fewer than this with a probability of about 4e-7.
AGREE = 28
#: Members of a table whose minhashes are compared with each other at once, and nodes of a chunk, whose whole sets are.
TABLE_BLOCK, CHUNK = 2048, 256
#: Members verified against one hub in one task's share.
HUB_SHARE = 512


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """The smallest value of each non-empty set under each of `count` hash functions."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    out = np.empty((len(sets), count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat((joined ^ seeds[2 * k]) * seeds[2 * k + 1], starts)
    return mix(out)


def prints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, signs, keys): a row's set size, the set's 128-bit fingerprint, 16 bits of
    every minhash, and a key for each collection. Without words the set is empty and the rest NULL."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, starts in slices(batch.column(1)):
                sets = shingle_sets(data, starts, words)
                size = np.array([len(s) for s in sets])
                some = np.flatnonzero(size)
                rows = len(sets)
                f1, f2 = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                signs, keys = [None] * rows, [None] * rows
                if len(some):
                    joined = np.concatenate(sets)
                    at = np.cumsum(np.append(0, size[some][:-1]))
                    for out, salt in ((f1, 1), (f2, 2)):
                        out[some] = np.add.reduceat(mix(joined ^ np.uint64(BASE * salt % 2**64)), at).view(np.int64)
                    low = minhashes([sets[i] for i in some], GROUPS * WIDTH)
                    short = (low >> np.uint64(48)).astype("<u2")
                    whole = np.zeros((len(some), GROUPS), np.uint64)
                    for k in range(WIDTH):
                        whole = whole * np.uint64(BASE) + low[:, k::WIDTH]
                    whole = mix(whole + np.arange(GROUPS, dtype=np.uint64)[None, :])
                    for i, r in enumerate(some.tolist()):
                        signs[r], keys[r] = short[i].tobytes(), whole[i].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(size, pa.int64()),
                        pa.array(f1, mask=size == 0),
                        pa.array(f2, mask=size == 0),
                        pa.array(signs, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "signs", "keys"],
                )

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return asked.mapInArrow(made, "doc_id long, n_shingles long, f1 long, f2 long, signs binary, keys array<long>")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, body): the whole texts of the named documents, each compressed by itself before it can meet a shuffle."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for first, data, starts in slices(batch.column(1)):
                bodies = [press.compress(data[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(bodies)), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(made, "doc_id long, body binary")
    return asked.join(ids, "doc_id", "left_semi").distinct()


def _set_of(body: bytes | pa.Buffer, words: int) -> np.ndarray:
    """The whole set of a compressed text."""
    data = np.frombuffer(zstandard.decompress(body), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]), words)[0]


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of documents whose whole sets reach the similarity."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, p = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                # A share's rows follow each other, so its hub's set is made once.
                if hub is None or not hub.equals(x.as_buffer()):
                    hub = x.as_buffer()
                    p = _set_of(hub, words)
                q = _set_of(y.as_buffer(), words)
                small, large = min(len(p), len(q)), max(len(p), len(q))
                same = len(np.intersect1d(p, q, assume_unique=True)) if 100 * small >= percent * large else 0
                keep.append(100 * same >= percent * (small + large - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # A hub with many members goes to as many tasks as it has shares of them.
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_SHARE).cast("int").alias("shares"))
    left = pairs.join(shares, "a").withColumn("share", F.pmod(F.xxhash64("b"), "shares").cast("int")).drop("shares")
    left = left.join(texts.select(F.col("doc_id").alias("b"), F.col("body").alias("other")), "b")
    hubs = texts.join(shares, texts["doc_id"] == shares["a"]).select("a", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "body")
    met = left.join(hubs, ["a", "share"]).select("a", "b", "body", "other")
    return met.mapInArrow(near, "a long, b long")


def _blocks(rows: Iterator[pa.RecordBatch], names: list[str], keys: int) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each run of rows with equal keys (the first `keys` columns), of two rows or more; binary columns are lists."""

    def cut(part: pa.Table) -> Iterator[dict[str, np.ndarray]]:
        columns = {c: part[c].to_pylist() if pa.types.is_binary(part.schema.field(c).type) else part[c].to_numpy() for c in names}
        edge = np.ones(part.num_rows, bool)
        edge[1:] = np.any([columns[c][1:] != columns[c][:-1] for c in names[:keys]], axis=0)
        cuts = np.append(np.flatnonzero(edge), part.num_rows).tolist()
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high - low > 1:
                yield {c: v[low:high] for c, v in columns.items()}

    rest: pa.Table | None = None
    for batch in rows:
        part = pa.Table.from_batches([batch])
        part = part if rest is None else pa.concat_tables([rest, part])
        key = [part[c].to_numpy() for c in names[:keys]]
        last = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0)) if part.num_rows else []
        at = int(last[-1]) + 1 if len(last) else 0
        yield from cut(part.slice(0, at)) if at else ()
        rest = part.slice(at)
    if rest is not None and rest.num_rows:
        yield from cut(rest)


def _near(signs: np.ndarray, size: np.ndarray, component: np.ndarray, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the others in another component than i, of a near size, and with enough minhashes equal; and which collections are."""
    others = others[(component[others] != component[i]) & (5 * np.minimum(size[others], size[i]) >= 4 * np.maximum(size[others], size[i]))]
    same = signs[others] == signs[i]
    whole = same.reshape(len(others), GROUPS, WIDTH).all(axis=2)
    ok = (same.sum(axis=1) >= AGREE) & (whole.sum(axis=1) >= 2)
    return others[ok], whole[ok]


def _signs(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, GROUPS * WIDTH)


def _open_units(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of chunks that hold a pair worth verifying, from blocks of tables (sorted by side); each pair in the first table where it meets."""
    for block in _blocks(rows, ["table", "x", "y", "side", "i", "j", "chunk", "n_shingles", "component", "signs"], 3):
        left, right = np.flatnonzero(block["side"] == 0), np.flatnonzero(block["side"] == 1)
        signs, found = _signs(block["signs"]), set()
        inner = block["x"][0] == block["y"][0]
        for i in left.tolist():
            others, whole = _near(signs, block["n_shingles"], block["component"], i, left[left > i] if inner else right)
            first = (whole & (np.cumsum(whole, axis=1) <= 2))[:, [block["i"][i], block["j"][i]]].all(axis=1)
            own = int(block["chunk"][i])
            found |= {(min(own, c), max(own, c)) for c in set(block["chunk"][others[first]].tolist())}
        if found:
            a, b = zip(*sorted(found), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _unit_links(words: int, percent: int):  # noqa: ANN202
    """A spanning forest of the verified links between components in each unit."""

    def links(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _blocks(rows, ["a", "b", "node", "n_shingles", "component", "signs", "body"], 2):
            signs, size, component = _signs(unit["signs"]), unit["n_shingles"], unit["component"].copy()
            sets, found = {}, []
            for i in range(len(size) - 1):
                others, _ = _near(signs, size, component, i, np.arange(i + 1, len(size)))
                # The likeliest first: once linked, the rest of that component needs no look.
                for j in others[np.argsort(-(signs[others] == signs[i]).sum(axis=1), kind="stable")].tolist():
                    if component[j] == component[i]:
                        continue
                    for k in {i, j} - sets.keys():
                        sets[k] = _set_of(unit["body"][k], words)
                    same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                        found.append((unit["node"][i], unit["node"][j]))
                        component[component == component[j]] = component[i]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


def open_pairs(rest: DataFrame) -> DataFrame:
    """(table, x, y, side, i, j, node, component): the members of tables dealt to pairs of blocks that may hold a link.

    A table's largest component has no links inside that anyone needs, so its blocks meet the others' blocks only: its g members go out once for every block of the
    o other members, those once for every block of the table. With one stray that is g rows and one for each TABLE_BLOCK of them, not g squared by TABLE_BLOCK.
    The hub met every member before and is left out.
    """
    sizes = rest.groupBy("table", "component").agg(F.count("*").alias("held"))
    sizes = sizes.groupBy("table").agg(F.max(F.struct("held", "component")).alias("most"), F.sum("held").alias("all"))
    blocks = {
        "giants": F.ceil(F.col("most.held") / TABLE_BLOCK).cast("int"),
        "others": F.ceil((F.col("all") - F.col("most.held")) / TABLE_BLOCK).cast("int"),
    }
    sizes = sizes.select("table", F.col("most.component").alias("giant"), *[c.alias(name) for name, c in blocks.items()])
    placed = rest.where("node <> hub").join(sizes, "table")
    inside, dealt = F.col("component") == F.col("giant"), F.xxhash64("node", "i")
    block = F.when(inside, F.pmod(dealt, "giants")).otherwise(F.col("giants") + F.pmod(dealt, "others")).cast("int")
    met = F.sequence(F.when(inside, F.col("giants")).otherwise(F.lit(0)), F.col("giants") + F.col("others") - 1)
    return placed.withColumn("block", block).withColumn("other", F.explode(met)).select(
        "table", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), (F.col("block") > F.col("other")).cast("int").alias("side"),
        "i", "j", "node", "component",
    )


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents are linked when 100 times the size of the intersection of their sets is at least
    `percent` times that of the union. component_id is the smallest doc_id reachable over links;
    kept is true for that document only. Texts without words, and NULL, are linked with nothing. A row without a
    doc_id can't be named: its component_id is NULL and it is kept. Rows that share a doc_id are
    one document, which has the links of all of them. Columns other than doc_id and text are not read. `percent` below 80 would need
    other table sizes and is refused.
    """
    if words < 1 or not 80 <= percent <= 100:
        raise ValueError("near_duplicates takes one word or more and a similarity from 80 to 100 percent")
    scratch = Scratch(docs.sparkSession)
    seen = scratch.keep(prints(docs, words), "prints")
    real = seen.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = real.groupBy("f1", "f2").agg(F.min("doc_id").alias("node"))
    nodes = scratch.keep(
        real.withColumnRenamed("doc_id", "node").join(classes, ["f1", "f2", "node"], "left_semi").dropDuplicates(["f1", "f2", "node"]), "nodes"
    )

    # Collections that two classes or more share, then their pairs: a table's key, and which collections it joins.
    halves = nodes.select("node", F.posexplode("keys").alias("at", "half"))
    shared = halves.join(halves.groupBy("half").count().where("count > 1").select("half"), "half")
    own = shared.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("at", "half"))).alias("own")).where("size(own) > 1")
    crossed = F.expr(
        "explode(flatten(transform(own, (p, n) -> transform(slice(own, n + 2, size(own)), q ->"
        " named_struct('table', xxhash64(p.half, q.half), 'i', p.at, 'j', q.at)))))"
    )
    tables = own.select("node", crossed.alias("t")).select("node", "t.*")
    hubs = tables.groupBy("table").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1")
    met = scratch.keep(tables.join(hubs, "table"), "met")
    pairs = scratch.keep(met.where("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    # Every member of a table is in one of these pairs, so these are the texts of the units below too.
    ids = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    texts = scratch.keep(texts_of(docs, ids), "texts")
    edges = scratch.keep(verified(pairs, texts, words, percent), "edges")
    scratch.drop("pairs", "ids")
    links = connected_components(edges, scratch, "links")

    # Tables whose members are still in different components.
    placed = met.join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("table").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    rest = scratch.keep(placed.join(mixed.select("table"), "table"), "open")
    # Chunks of nodes by their smallest hub: near ones are together.
    homes = rest.groupBy("node").agg(F.min("hub").alias("home"), F.min("component").alias("component"))
    parts = homes.groupBy("home").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    chunk = F.xxhash64("home", F.pmod(F.xxhash64("node"), "parts"))
    chunks = scratch.keep(homes.join(parts, "home").select("node", "component", chunk.alias("chunk")), "chunks")

    dealt = open_pairs(rest)
    dealt = dealt.join(nodes.select("node", "n_shingles", "signs"), "node").join(chunks.select("node", "chunk"), "node")
    dealt = dealt.select("table", "x", "y", "side", "i", "j", "chunk", "n_shingles", "component", "signs")
    dealt = dealt.repartition("table", "x", "y").sortWithinPartitions("table", "x", "y", "side")
    units = scratch.keep(dealt.mapInArrow(_open_units, "a long, b long").distinct(), "units")
    there = units.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk")).join(chunks, "chunk")
    needed = chunks.join(units.select(F.explode(F.array("a", "b")).alias("chunk")).distinct(), "chunk", "left_semi").select(F.col("node").alias("doc_id"))
    bodies = texts.join(needed, "doc_id", "left_semi").withColumnRenamed("doc_id", "node")
    whole = scratch.keep(bodies.join(nodes.select("node", "n_shingles", "signs"), "node"), "whole")
    met_texts = there.join(whole, "node").select("a", "b", "node", "n_shingles", "component", "signs", "body")
    more = met_texts.repartition("a", "b").sortWithinPartitions("a", "b", "node").mapInArrow(_unit_links(words, percent), "a long, b long")
    all_links = connected_components(
        edges.unionByName(links.select(F.col("node").alias("a"), F.col("component").alias("b"))).unionByName(more), scratch, "all-links"
    )
    named = scratch.keep(
        classes.join(all_links, "node", "left").select("f1", "f2", F.coalesce("component", "node").alias("class")), "named"
    )
    scratch.drop("nodes", "met", "open", "edges", "chunks", "units", "texts", "whole")
    marked = seen.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    return marked.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, without those that near_duplicates does not keep. Rows without a doc_id stay."""
    lost = near_duplicates(docs, words, percent).where("NOT kept").select("doc_id").distinct()
    name = "lost_id"
    while name in docs.columns:
        name += "_"
    lost = lost.withColumnRenamed("doc_id", name)
    return docs.join(lost, docs["doc_id"] == lost[name], "left_anti")
