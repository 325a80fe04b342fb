"""Approximate nearest neighbours with a vantage-point tree per shard.

Vectors are dealt to shards by a hash of their id. Each shard keeps one tree:
a node takes a vantage point, orders the rest by distance to it and halves
them, so a tree is balanced whatever the ties. A query descends the nearer half
first and skips a half when the triangle inequality bounds it away from the k
nearest found so far. `factor` relaxes that bound: the half is skipped when
`factor` times its bound exceeds the k-th distance, so 1 gives the exact
answer and larger factors visit less.

A shard's rows and all queries meet in one task, rows first: the tree is built
once and queries stream through it, QUERY_ROWS at a time. Shards grow with the
table up to SHARD_ROWS, so that queries are copied as rarely as memory allows.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, and rows without id take no part; of rows that repeat an id with
one vector all are candidates (their common id comes back once per row); rows
that repeat an id are queries of their own, each with its own ranks from 1, told
apart by `query_row`; only the very row is left out of its own answer, others
with its id are not; equal distances go to the smaller id; shorter vectors count
as padded with zeros; fewer than k candidates give all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import matrix, shuffle_partitions, usable, written

SHARD_ROWS = (8_192, 65_536)  # fewest and most: as many as give every task one, between them
QUERY_ROWS = 512
LEAF = 96


def shard_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, shard_rows: int | None
) -> tuple[DataFrame, int, int]:
    """(row, shard, id, vector) of all usable rows, the number of shards, the longest vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable("vector"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    least, most = SHARD_ROWS
    each = shard_rows or min(most, max(least, -(-size["n"] // shuffle_partitions(vectors.sparkSession))))
    shards = max(1, -(-size["n"] // each))
    shard = F.pmod(F.xxhash64("id", "row"), F.lit(shards)).cast("int")
    return rows.withColumn("shard", shard), shards, size["width"] or 1


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    factor: float = 1.5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), id_col, score, query_row: the k nearest found of
    each row of `vectors` for which `queries` holds (a condition on `id`).

    Every row goes to its shard once, every query to each shard; only k rows
    per query and shard go on.
    """
    rows, shards, width = shard_vectors(vectors, id_col, vector_col, shard_rows)
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    index = rows.select("shard", F.lit(0).alias("role"), "row", "id", "vector")
    posed = rows.filter(queries).select(every_shard, F.lit(1).alias("role"), "row", "id", "vector")
    work = index.unionByName(posed).repartition("shard").sortWithinPartitions("shard", "role", "id", "row")
    found = work.mapInArrow(searcher(width, k, factor), "query_row long, query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "id"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score", "query_row")


def searcher(width: int, k: int, factor: float) -> Callable:
    """(shard, role, row, id, vector) sorted by the first two to the answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            place = batch.column("shard").to_numpy() * 2 + batch.column("role").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b == a:
                    continue
                part, (here, role) = batch.slice(a, b - a), divmod(int(place[a]), 2)
                if here != shard:
                    shard, held, tree = here, [], None
                if role == 0:
                    held.append(part)
                    continue
                if tree is None:
                    if not held:
                        continue
                    index = pa.Table.from_batches(held)
                    ids, rows = (index.column(c).to_numpy() for c in ("id", "row"))
                    tree, held = VantageTree(ids, rows, matrix(index.column("vector"), width), k), []
                for at in range(0, part.num_rows, QUERY_ROWS):
                    asked = part.slice(at, QUERY_ROWS)
                    ids, rows = asked.column("id").to_numpy(), asked.column("row").to_numpy()
                    who, answer, score = tree.nearest(rows, matrix(asked.column("vector"), width), factor)
                    columns = [pa.array(x) for x in (rows[who], ids[who], answer, score)]
                    yield pa.RecordBatch.from_arrays(columns, ["query_row", "query_id", "id", "score"])

    return run


class VantageTree:
    """A balanced tree over distinct points; each point carries its ids.

    A node's halves keep the closest and farthest distance of their points to
    the vantage point. Of equal vectors only the k + 1 smallest ids can ever be
    among k neighbours, one of them perhaps being the query's own row.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, k: int) -> None:
        self.k = k
        keys = np.ascontiguousarray(points + 0.0).view(f"V{8 * points.shape[1]}").ravel()
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        self.points = points[first]
        order = np.lexsort((rows, ids, group))
        rank = np.arange(len(ids)) - np.searchsorted(group[order], group[order])
        keep = rank <= k
        self.ids, self.rows = ids[order][keep], rows[order][keep]
        self.bounds = np.searchsorted(group[order][keep], np.arange(len(first) + 1))
        self.root = self._build(np.arange(len(first)))

    def _build(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members
        vantage = members[len(members) // 2]
        rest = members[members != vantage]
        away = distances(self.points[vantage][None], self.points[rest])[0]
        order = np.argsort(away, kind="stable")
        half = len(rest) // 2
        near, far = order[:half], order[half:]
        return (
            vantage,
            (away[near[0]], away[near[-1]], self._build(rest[near])),
            (away[far[0]], away[far[-1]], self._build(rest[far])),
        )

    def nearest(self, query_rows: np.ndarray, queries: np.ndarray, factor: float):
        """(query, id, score) of the k nearest found of every query, as places in `queries`."""
        self.factor, self.query_rows, self.queries = factor, query_rows, queries
        self.score = np.full((len(queries), self.k), np.inf)
        self.answer = np.full((len(queries), self.k), np.iinfo(np.int64).max)
        self._visit(self.root, np.arange(len(queries)))
        found = np.isfinite(self.score)
        query = np.repeat(np.arange(len(queries)), found.sum(axis=1))
        return query, self.answer[found], self.score[found]

    def _visit(self, node, asked: np.ndarray) -> None:
        if not len(asked):
            return
        if isinstance(node, np.ndarray):
            self._offer(asked, node, distances(self.queries[asked], self.points[node]))
            return
        vantage, *halves = node
        away = distances(self.queries[asked], self.points[vantage][None])[:, 0]
        self._offer(asked, np.array([vantage]), away[:, None])
        bound = [np.maximum(0, np.maximum(lo - away, away - hi)) for lo, hi, _ in halves]
        near_first = away - halves[0][1] <= halves[1][0] - away
        for first in (0, 1):
            mine = near_first if first == 0 else ~near_first
            for half in (first, 1 - first):
                reach = self.score[asked, -1] >= self.factor * bound[half] * (1 - 1e-12)
                self._visit(halves[half][2], asked[mine & reach])

    def _offer(self, asked: np.ndarray, members: np.ndarray, away: np.ndarray) -> None:
        """Merge the ids of `members` into the best k of the queries `asked`."""
        size = self.bounds[members + 1] - self.bounds[members]
        column = np.repeat(np.arange(len(members)), size)
        place = np.arange(len(column)) - np.repeat(np.cumsum(size) - size, size)
        entry = self.bounds[members][column] + place
        ids = self.ids[entry]
        score = away[:, column]
        hit = (score <= self.score[asked, -1][:, None]).any(axis=1)
        if not hit.any():
            return
        asked, score = asked[hit], score[hit]
        score = np.where(self.rows[entry][None] == self.query_rows[asked][:, None], np.inf, score)
        both = np.concatenate([self.score[asked], score], axis=1)
        names = np.concatenate([self.answer[asked], np.broadcast_to(ids, score.shape)], axis=1)
        order = np.lexsort((names, both), axis=1)[:, : self.k]
        self.score[asked] = np.take_along_axis(both, order, axis=1)
        self.answer[asked] = np.take_along_axis(names, order, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances from differences, in doubles, a few rows at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 21) // max(1, b.size))
    for at in range(0, len(a), step):
        gap = a[at : at + step, None, :] - b[None]
        out[at : at + step] = np.sqrt(np.einsum("abd,abd->ab", gap, gap))
    return out
