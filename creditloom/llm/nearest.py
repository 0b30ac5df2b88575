"""Approximate nearest neighbours by collision-counting hashing.

Vectors are scaled to length one and projected on `PROJECTIONS` random lines; each line is an array sorted by
projection. A query opens a window around its own projection on every line and widens all of them step by step (virtual
rehashing: the same arrays serve every width). A vector that stands in the windows of `COLLISIONS` lines is verified with the
query. A query ends once its k-th best distance is so small that a nearer vector would have collided often enough, or
everything has been verified.

The rows are split into blocks of at most some `BLOCK_ROWS`, each with arrays of its own, and every block answers all queries;
the answers of the blocks are merged. Queries travel in large chunks, each of which meets the arrays of a block once, so neither
side of a task grows with the table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import groups_for, importable, staged

PROJECTIONS = 128
COLLISIONS = 90
REACH = 1.18  # half a window over the distance at which 97 of 100 vectors collide often enough
FIRST_WINDOW = 0.25  # half of it
GROWTH, FINE = 1.4, 1.05  # of a window that holds few of the rows, and of one that holds many, where each step adds much to verify
MANY = 0.6
BLOCK_ROWS, LEAST_ROWS = 32768, 4096  # of a block; small ones cost more for each row
CHUNK_QUERIES = 16384  # that meet a block in one task, on the same arrays
QUERIES = 512  # of them at a time
SEED = 2

FOUND = "query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """Projections of a block of vectors, sorted on each line."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.lengths = np.sqrt(np.add.reduce(vectors * vectors, axis=1))
        self.lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        places = (vectors / self.lengths[:, None]) @ self.lines
        order = np.argsort(places, axis=0).T
        self.sorted = np.take_along_axis(places.T, order, axis=1)
        self.order = order.ravel()  # one line after another
        self.begins = np.arange(PROJECTIONS) * len(vectors)

    def cosines(self, query: np.ndarray, length: float, rows: np.ndarray) -> np.ndarray:
        return np.add.reduce(self.vectors[rows] * query, axis=1) / (self.lengths[rows] * length)

    def windows(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin and end, for bounds of queries (rows) on lines (columns)."""
        pairs = [(np.searchsorted(x, a, "left"), np.searchsorted(x, b, "right")) for x, a, b in zip(self.sorted, low.T, high.T, strict=True)]
        return np.stack([a for a, _ in pairs], axis=1), np.stack([b for _, b in pairs], axis=1)

    def rows(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The vectors between two places on each line, and so with repetitions."""
        sizes = ends - begins
        shift = self.begins.repeat(len(sizes) // PROJECTIONS) + begins - (np.cumsum(sizes) - sizes)
        return self.order[np.repeat(shift, sizes) + np.arange(sizes.sum())]

    def search(self, queries: np.ndarray, own: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows verified for each query and their cosines, among them its k nearest. `own` are rows that don't count."""
        count = len(self.vectors)
        lengths = np.sqrt(np.add.reduce(queries * queries, axis=1))
        places = (queries / lengths[:, None]) @ self.lines
        begins, ends = self.windows(places, places)
        begins = ends.copy()
        seen = np.zeros((len(queries), count), np.uint8)  # there are fewer lines than it holds
        left = np.ones((len(queries), count), bool)
        for q, rows in enumerate(own):
            left[q, rows] = False
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
        active = np.flatnonzero(left.any(axis=1))
        half = FIRST_WINDOW
        while len(active):
            lows, highs = self.windows(places[active] - half, places[active] + half)
            lows, highs = np.minimum(lows, begins[active]), np.maximum(highs, ends[active])
            ended = []
            for q, low, high in zip(active, lows, highs, strict=True):
                # What the wider window adds on both sides of each line.
                sides = np.stack([low, ends[q]], axis=1).ravel(), np.stack([begins[q], high], axis=1).ravel()
                seen[q] += np.bincount(self.rows(*sides), minlength=count).astype(np.uint8)
                hits = np.flatnonzero(left[q] & (seen[q] >= COLLISIONS))
                if not len(hits):
                    continue
                left[q, hits] = False
                found[q].append((hits, self.cosines(queries[q], lengths[q], hits)))
                best = np.concatenate([scores for _, scores in found[q]])
                if len(best) >= k:
                    nearest = np.partition(best, len(best) - k)[len(best) - k]
                    if math.sqrt(max(0.0, 2 - 2 * nearest)) * REACH <= half:
                        ended.append(q)
                if not left[q].any():
                    ended.append(q)
            begins[active], ends[active] = lows, highs
            held = (highs - lows).mean() / count
            active = np.setdiff1d(active, ended)
            half *= FINE if held > MANY else GROWTH
        none = np.zeros(0, np.int64), np.zeros(0)
        return [tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else none for parts in found]


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([x.flatten() for x in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def answer(k: int):
    """Over a block of vectors and a chunk of queries: the k nearest of each query within the block, and ties of the last."""

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and queries.num_rows:
            index = Index(matrix(block.column("vector")))
            ids = block.column("id").to_numpy()
            by_id = np.argsort(ids, kind="stable")
            asked = queries.column("id").to_numpy()
            spans = zip(*(np.searchsorted(ids, asked, side, sorter=by_id) for side in ("left", "right")), strict=True)
            own = [by_id[a:b] for a, b in spans]
            points = matrix(queries.column("vector"))
            for at in range(0, len(asked), QUERIES):
                some = slice(at, at + QUERIES)
                found = index.search(points[some], own[some], k)
                for query_id, (rows, scores) in zip(asked[some].tolist(), found, strict=True):
                    best = np.lexsort((ids[rows], -scores))[:k]
                    out += [(query_id, int(ids[r]), float(s)) for r, s in zip(rows[best], scores[best], strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """The `k` largest cosines of each query with the rows of `vectors`: `query_id`, `rank` (from 1), `vec_id`, `score`.

    A query isn't compared with rows of its own id; with fewer rows than `k` it gets them all. Ties go to the smaller id. Rows without
    an id, and vectors that are null, empty, zero, or hold null or non-finite components, take no part; vectors are only
    compared with those of as many components. Rows that repeat an id count once, with the vector that sorts first. Other columns are not
    read. Without queries or vectors there are no rows.
    """

    def rows_of(table: DataFrame) -> DataFrame:
        rows = table.where(usable(vector) & F.col(vec_id).isNotNull())
        rows = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return staged(rows.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector")))

    spark = vectors.sparkSession
    importable(spark)
    base, asked = rows_of(vectors), rows_of(queries)
    count = base.count()
    blocks = max(1, math.ceil(count / BLOCK_ROWS), min(groups_for(spark, 0, 1), count // LEAST_ROWS))
    chunks = max(1, math.ceil(asked.count() / CHUNK_QUERIES))
    placed = base.select(
        "id", "vector", "dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    )
    sent = asked.select(
        "id", "vector", "dim", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk")
    )
    keys = ["dim", "block", "chunk"]
    found = placed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(answer(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
