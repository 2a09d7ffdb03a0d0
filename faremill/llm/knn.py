"""Exact top-k search by a Voronoi join.

Every vector belongs to the cell of its nearest pivot, queries and candidates alike. A cell's summary is its size, its radius and the
distances of its k + 1 members nearest to the pivot; a group of queries has the radius of its own. First each query is solved in its own
cell, which gives k real scores. The rest goes by bounds: no product of a group of queries with a cell exceeds a bound that follows from the
two pivots and radii, and pairs of a group and a cell whose bound is below the least k-th score of the group are left out as a whole; in the others a query is
sent where its own bound, from its products with the pivots, reaches its k-th score. It is solved there against blocks of bounded
size, and the best of its blocks are ranked.

It is the queries that are replicated, on their own bounds, and the data that stays where it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.scratch import Scratch

#: Pivots are the square root of the rows, within these bounds; rows of the sample for each; rows of a block.
LEAST_PIVOTS, MOST_PIVOTS, SAMPLE, BLOCK = 8, 256, 8, 16_384
#: Whole numbers that doubles hold exactly.
EXACT = 2.0**53
LONG = 2**63


def _choose_pivots(rows: np.ndarray, count: int, turns: int = 6) -> np.ndarray:
    """Centres of a sample: seeds far from each other, then a few turns of k-means. Any choice is right; a better one prunes more."""
    chosen, apart = [0], np.full(len(rows), np.inf)
    while len(chosen) < min(count, len(rows)):
        apart = np.minimum(apart, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
        if apart.max() == 0:
            break
        chosen.append(int(apart.argmax()))
    centres = rows[chosen]
    for _ in range(turns):
        own = ((centres**2).sum(axis=1) - 2 * (rows @ centres.T)).argmin(axis=1)
        centres = np.stack([rows[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
    return centres


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def whole_numbers(frame: DataFrame, id_column: str, vector_column: str, is_query: Column) -> DataFrame:
    """(vec_id, is_query, size, vector): floor(1024 * x) of every component. Vectors that are NULL or hold a NULL or a
    value that is not finite, and rows without an id, take no part; nor do those with a component whose product with 1024 is beyond a double."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, vectors, sizes = [], [], []
            for v in batch.column(2):
                x = np.array([np.nan if c is None else c for c in v.as_py()], np.float64)
                keep.append(bool(np.isfinite(x).all()))
                with np.errstate(over="ignore"):
                    whole = np.floor(1024 * x) if keep[-1] else x[:0]
                keep[-1] &= bool(np.isfinite(whole).all())
                vectors.append(whole.tobytes())
                sizes.append(len(whole))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(vectors, pa.binary())], ["vec_id", "is_query", "size", "vector"]
            )
            yield out.filter(pa.array(keep, pa.bool_()))

    asked = frame.select(F.col(id_column).cast("long").alias("vec_id"), is_query.alias("is_query"), F.col(vector_column).cast("array<double>").alias("v"))
    return asked.where("vec_id IS NOT NULL AND v IS NOT NULL").mapInArrow(made, "vec_id long, is_query boolean, size int, vector binary")


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where they are, else in Python's integers, at the ends of a long if beyond."""
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if bound < EXACT:
        return (queries @ rows.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    return np.clip(exact, -LONG, LONG - 1).astype(np.int64)


def _solver(width: int, k: int):  # noqa: ANN202
    """For each block (sorted: its members, then its queries), every query's k best of it that reach the query's own bound."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, rows = None, [], [], None
        for batch in batches:
            cell, block, kind = (batch.column(c).to_numpy() for c in (0, 1, 2))
            edge = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for low, high in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if (int(cell[low]), int(block[low])) != key:
                    key, ids, parts, rows = (int(cell[low]), int(block[low])), [], [], None
                if not kind[low]:
                    ids.append(part.column(3).to_numpy())
                    parts.append(_matrix(part.column(4), width))
                    continue
                if not parts:
                    continue
                if rows is None:
                    members = np.concatenate(ids)
                    order = np.argsort(members, kind="stable")
                    members, rows = members[order], np.concatenate(parts)[order]
                for i in range(0, part.num_rows, 64):
                    yield best(part.slice(i, 64), members, rows)

    def best(part: pa.RecordBatch, members: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        asked, least = part.column(3).to_numpy(), part.column(5).to_numpy()
        scores = _products(_matrix(part.column(4), width), rows)
        out = []
        for q, own, s in zip(asked.tolist(), least, scores, strict=True):
            at = np.flatnonzero((members != q) & (s >= own))
            if len(at) > k:
                at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
            at = at[np.argsort(-s[at].astype(object) if len(at) and s[at].min() == -LONG else -s[at], kind="stable")[:k]]
            out += [(q, m, x) for m, x in zip(members[at].tolist(), s[at].tolist(), strict=True)]
        columns = [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ()))]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return solve


def _held(scores: np.ndarray) -> np.ndarray:
    """Least scores as bounds are held to them: at an end of a long any product beyond it ties."""
    return np.where(scores <= -float(LONG), -np.inf, np.minimum(scores, float(LONG)))


class VoronoiJoin:
    """The cells of a table's vectors, and the two rounds in which its queries are solved."""

    def __init__(self, frame: DataFrame, is_query: Column, k: int, id_column: str, vector_column: str):
        self.spark, self.k, self.scratch = frame.sparkSession, k, Scratch(frame.sparkSession)
        whole = self.scratch.keep(whole_numbers(frame, id_column, vector_column, F.coalesce(is_query, F.lit(False))), "whole")
        rows, width = whole.agg(F.count("*"), F.max("size")).first()
        self.width = width or 1
        count = max(LEAST_PIVOTS, min(MOST_PIVOTS, round(rows**0.5)))
        # A sample for the pivots, of SAMPLE rows for each of them at most; it decides how much is pruned, not the result.
        picked = [r["vector"] for r in whole.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(SAMPLE * count).collect()]
        padded = [np.frombuffer(v, np.float64) for v in picked]
        self.pivots = _choose_pivots(np.stack([np.pad(v, (0, self.width - len(v))) for v in padded]) if padded else np.zeros((1, self.width)), count)
        self.cells = self.scratch.keep(self._placed(whole), "cells")
        near = self.cells.withColumn("nth", F.row_number().over(Window.partitionBy("cell").orderBy("away"))).where(F.col("nth") <= k + 1)
        self.radius = {r["cell"]: (r["n"], r["far"]) for r in self.cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("far")).collect()}
        inner = near.select("cell", "away").collect()
        self.inner_cell, self.inner_away = np.array([r["cell"] for r in inner], int), np.array([r["away"] for r in inner])
        self.blocks = {c: -(-n // BLOCK) for c, (n, _) in self.radius.items()}
        spread = self.spark.createDataFrame(sorted(self.blocks.items()), "own_cell int, blocks int")
        self.members = self.cells.join(F.broadcast(spread), F.col("cell") == F.col("own_cell")).select(
            "cell", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "vector", F.lit(0.0).alias("least")
        )
        self.queries = self.cells.where("is_query").select("vec_id", "vector", "cell", "away")

    def _placed(self, whole: DataFrame) -> DataFrame:
        """Every vector with the cell of its nearest pivot and the distance; rows that repeat an id count once, as the first in order of their vectors."""
        pivots, width, heights = self.pivots, self.width, (self.pivots**2).sum(axis=1)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                full = [v + bytes(8 * width - len(v)) for v in batch.column(3).to_pylist()]
                rows = np.frombuffer(b"".join(full), np.float64).reshape(-1, width)
                cell = (heights - 2 * (rows @ pivots.T)).argmin(axis=1)
                away = np.sqrt(((rows - pivots[cell]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(away), pa.array(full, pa.binary())],
                    ["vec_id", "is_query", "cell", "away", "vector"],
                )

        rows = whole.mapInArrow(placed, "vec_id long, is_query boolean, cell int, away double, vector binary")
        one = F.min(F.struct("vector", "cell", "away")).alias("one")
        return rows.groupBy("vec_id").agg(F.max("is_query").alias("is_query"), one).select("vec_id", "is_query", "one.cell", "one.away", "one.vector")

    def solved(self, sent: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) of the queries in the blocks that they are sent to: the k best of each block."""
        units = self.members.join(sent.select("cell").distinct(), "cell", "left_semi").select("cell", "block", "kind", "vec_id", "vector", "least").unionByName(sent)
        units = units.repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
        return units.mapInArrow(_solver(self.width, self.k), "query_id long, vec_id long, score long")

    def best(self, found: DataFrame) -> DataFrame:
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return ranked.where(F.col("rank") <= self.k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    def first_sent(self) -> DataFrame:
        """Every query, to the blocks of its own cell."""
        spread = self.spark.createDataFrame(sorted(self.blocks.items()), "own_cell int, blocks int")
        block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        own = self.queries.join(F.broadcast(spread), F.col("cell") == F.col("own_cell"))
        return own.select("cell", block, F.lit(1).alias("kind"), "vec_id", "vector", F.lit(-float(LONG)).alias("least"))

    def rest_sent(self, first: DataFrame) -> DataFrame:
        """The queries, to the blocks of the other cells that the bounds don't leave out, given the first round's results."""
        reached = first.where(F.col("rank") == self.k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("reached"))
        asked = self.scratch.keep(self.queries.join(reached, "vec_id", "left").withColumn("reached", F.coalesce("reached", F.lit(-float(LONG)))), "asked")
        groups = {r["cell"]: r for r in asked.groupBy("cell").agg(F.max("away").alias("away"), F.min("reached").alias("least")).collect()}
        pivots, k, width, blocks, inner_cell, inner_away = self.pivots, self.k, self.width, self.blocks, self.inner_cell, self.inner_away
        filled = np.array(sorted(self.radius), int)
        far = np.array([self.radius[c][1] for c in filled.tolist()])
        # Pairs of a group of queries and a cell, from the summaries of both.
        allowed = np.zeros((len(pivots), len(filled)), bool)
        heights = np.sqrt((pivots**2).sum(axis=1)) * (1 + 1e-9)
        for g, group in groups.items():
            bound = pivots[g] @ pivots[filled].T + heights[g] * far + heights[filled] * group["away"] + far * group["away"]
            allowed[g] = bound + 1e-9 * (1 + np.abs(bound)) + 1 >= _held(np.array([group["least"]]))[0]

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    rows, cell_of, real = _matrix(part.column(1), width), part.column(2).to_numpy(), part.column(3).to_numpy()
                    length = np.sqrt((rows**2).sum(axis=1)) * (1 + 1e-9)
                    along = rows @ pivots.T
                    slip = 1e-9 * (1 + np.abs(along).max()) + 1
                    own = real
                    if len(inner_cell) > k:
                        # One of the k + 1 may be the query's own row.
                        reached = along[:, inner_cell] - length[:, None] * inner_away[None, :] - slip
                        own = np.maximum(own, np.partition(reached, -(k + 1), axis=1)[:, -(k + 1)])
                    own = _held(own)
                    needed = along[:, filled] + length[:, None] * far[None, :] + slip >= own[:, None]
                    needed &= allowed[cell_of] & (filled[None, :] != cell_of[:, None])
                    at, c = np.nonzero(needed)
                    times = np.array([blocks[x] for x in filled[c].tolist()], int)
                    at, cell = np.repeat(at, times), np.repeat(filled[c], times)
                    block = np.concatenate([np.arange(t) for t in times]) if len(times) else np.zeros(0, int)
                    least = np.maximum(np.floor(own), -float(LONG))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int32()), pa.array(block, pa.int32()), pa.array(np.ones(len(at), np.int32)), part.column(0).take(pa.array(at)),
                         part.column(1).take(pa.array(at)), pa.array(least[at])],
                        ["cell", "block", "kind", "vec_id", "vector", "least"],
                    )

        schema = "cell int, block int, kind int, vec_id long, vector binary, least double"
        return self.scratch.keep(asked.select("vec_id", "vector", "cell", "reached").mapInArrow(sent, schema), "sent")


def top_k(frame: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each row where `is_query` holds, the k other rows with the highest inner product
    of the whole numbers floor(1024 * x), ties to the smaller id; fewer where there are fewer.

    Shorter vectors count as ending in zeros. A row that repeats another's id is that row: it is not a candidate for it, and repeated rows of an
    id count once; of differing vectors one is taken, the same in every run. Columns other than the id, the vector and those of `is_query` are not read.
    """
    join = VoronoiJoin(frame, is_query, k, id_column, vector_column)
    first = join.scratch.keep(join.best(join.solved(join.first_sent())), "first")
    rest = join.solved(join.rest_sent(first))
    return join.best(first.select("query_id", "vec_id", "score").unionByName(rest))
