"""Exact top-k search by inner product, over a pivot-distance index.

Inner products become distances by one more component: vectors get sqrt(M - |x|^2), M being the largest
squared length, queries get 0; then the larger the product, the smaller the distance. Every vector is
keyed by its nearest pivot and its distance to it, and the table is ordered by that key, so a run of rows is
an annulus around a pivot. By the triangle inequality no vector of an annulus [a, b] is nearer to a
query at distance d from the pivot than max(a - d, d - b, 0). A query expands the annuli from the nearest on and
stops where this bound shows that no score can reach its fifth best.

The pivots are chosen from a bounded sample (`SAMPLE` vectors with the smallest hash, farthest first); the
index holds every vector. The result does not depend on the pivots: bounds are used with a margin for rounding, and
scores are whole numbers, computed exactly.

Scale: the index is a written table in ranges of (pivot, distance, id), so a hot pivot, or one vector that
fills a third of the table, is spread over tasks. Queries are a stated set, read from the table by the driver in
blocks of a bounded number of vectors; each block is sent to all tasks, which return k rows per query, and these are
reduced by an aggregation with partial results. A first search in a few rows gives every query a score to beat.

Defined cases: vectors that are null, empty, of another dimension than most, or that hold null or
non-finite components take no part, as queries or candidates. Ties go to the smaller id. Rows of equal id are
separate candidates with equal id, and a query skips all rows of its own id; a repeated query id is
searched once, for its greatest vector. Rows without id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, settle

SCALE = 256
EVERY, K = 50, 5
PIVOTS, SAMPLE = 32, 2048
#: Vectors of an annulus, queries of a block.
ANNULUS, BLOCK = 512, 8192
#: Below every score; its negative is a whole number too.
SMALLEST = -(1 << 62)


def quantised(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id and v (array of long): the whole parts of the scaled components; rows that take no part are left out."""
    v = F.col(vector)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    usable = rows.where(F.col(row_id).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    return usable.select(
        F.col(row_id).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    """At most n different points, each the farthest from those before."""
    chosen = [0]
    away = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def sampled(rows: DataFrame, n: int, total: int) -> list:
    """At most n rows, those of the smallest hash; tasks send only rows whose hash is small enough to matter."""
    turn, steps = F.xxhash64("vec_id", "v"), 1 << 20
    near = F.pmod(turn, F.lit(steps)) <= 4 * n * steps // max(total, 1)
    return rows.where(near).orderBy(F.pmod(turn, F.lit(steps)), turn, "vec_id").limit(n).collect()


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the component that makes all of them equally long."""
    v = vectors.astype(np.float64)
    return np.hstack([v, np.sqrt(np.maximum(longest - (v * v).sum(1, keepdims=True), 0))])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


class Index:
    """The pivots (a few numbers, sent to all tasks) and the written table in order of (pivot, distance, id)."""

    def __init__(self, rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE):
        """rows: vec_id and v."""
        sizes = rows.groupBy(F.size("v").alias("n")).agg(
            F.count("*").alias("rows"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("longest"),
            F.max(F.array_max(F.transform("v", F.abs))).alias("largest"),
        ).orderBy(F.desc("rows"), F.desc("n")).first()
        self.dimension = sizes["n"] if sizes else 0
        if not self.dimension:
            self.table = rows.select("vec_id", "v", F.lit(0).alias("pivot"), F.lit(0.0).alias("distance")).where("false")
            return
        self.longest = float(sizes["longest"])
        #: products of whole numbers are exact in floating point up to 2^53; beyond, long integers are used
        self.exact = self.dimension * float(sizes["largest"]) ** 2 < 2**53
        rows = rows.where(F.size("v") == self.dimension)
        chosen = sampled(rows, sample, sizes["rows"])
        self.rows = sizes["rows"]
        points = lifted(np.array([r["v"] for r in chosen], np.int64), self.longest)
        self.pivots = farthest_first(points, pivots)
        longest, dimension, centres = self.longest, self.dimension, self.pivots

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                away = distances(lifted(matrix(batch.column("v"), dimension), longest), centres)
                near = away.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near])],
                    ["vec_id", "v", "pivot", "distance"],
                )

        keyed = settle(map_arrow(rows, run, "vec_id long, v array<long>, pivot int, distance double"), "keyed")
        order = ["pivot", "distance", "vec_id"]
        self.table = settle(keyed.repartitionByRange(*order).sortWithinPartitions(*order), "annuli")


def bound(from_pivot: np.ndarray, squared: np.ndarray, longest: float, low: float, high: float) -> np.ndarray:
    """The largest product that a vector of an annulus can have with each query, with a margin for rounding."""
    gap = np.maximum(np.maximum(low - from_pivot, from_pivot - high), 0)
    scale = longest + squared + 1
    return (squared + longest - np.maximum(gap - 1e-9 * np.sqrt(scale), 0) ** 2) / 2 + 1e-9 * scale + 1


class Best:
    """The k best of every query so far: scores and ids, best first; ties to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.scores, self.ids = np.full((n, k), SMALLEST), np.full((n, k), np.iinfo(np.int64).max)
        self.floor = floor

    def to_beat(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: queries x candidates (SMALLEST: no candidate)."""
        k = self.scores.shape[1]
        all_scores = np.hstack([self.scores[queries], scores])
        all_ids = np.hstack([self.ids[queries], np.broadcast_to(ids, scores.shape)])
        if all_scores.shape[1] > 4 * k:
            # only what reaches the k-th score of its row can stay; ties at it all remain
            limit = -np.partition(-all_scores, k - 1, axis=1)[:, k - 1 : k]
            width = int((all_scores >= limit).sum(1).max())
            top = np.argsort(-all_scores, axis=1, kind="stable")[:, :width]
            all_scores, all_ids = np.take_along_axis(all_scores, top, 1), np.take_along_axis(all_ids, top, 1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        self.scores[queries] = np.take_along_axis(all_scores, order, 1)
        self.ids[queries] = np.take_along_axis(all_ids, order, 1)


def searched(index: Index, table: DataFrame, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int, exclude: bool) -> DataFrame:
    """query_id, vec_id, score: of every task's part of the table the k best of each query that reach its floor."""
    longest, pivots, exact, dimension = index.longest, index.pivots, index.exact, index.dimension
    squared = (vectors.astype(np.float64) ** 2).sum(1)
    padded = np.hstack([vectors.astype(np.float64), np.zeros((len(vectors), 1))])
    sent = table.sparkSession.sparkContext.broadcast((ids, vectors, floor, squared, distances(padded, pivots)))  # one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, floor, squared, from_pivots = sent.value
        best = Best(len(ids), k, floor)
        numbers = vectors.astype(np.float64) if exact else vectors
        for batch in batches:
            candidates, pivot = batch.column("vec_id").to_numpy(), batch.column("pivot").to_numpy()
            distance, rows = batch.column("distance").to_numpy(), matrix(batch.column("v"), dimension)
            cuts = np.union1d(np.flatnonzero(np.diff(pivot)) + 1, np.arange(0, len(pivot), ANNULUS))
            annuli = [(a, b) for a, b in zip(cuts, np.r_[cuts[1:], len(pivot)], strict=True) if b > a]
            limits = np.stack([bound(from_pivots[:, pivot[a]], squared, longest, distance[a:b].min(), distance[a:b].max()) for a, b in annuli], 1)
            order = np.argsort(-limits, axis=1)
            going = np.arange(len(ids))
            for turn in range(len(annuli)):
                # each query's next annulus; a query stops for good where even that cannot reach its best
                nearest = order[going, turn]
                alive = limits[going, nearest] >= best.to_beat()[going]
                going, nearest = going[alive], nearest[alive]
                if not len(going):
                    break
                for which in np.unique(nearest):
                    own, (a, b) = going[nearest == which], annuli[which]
                    part = rows[a:b].astype(np.float64) if exact else rows[a:b]
                    scores = (numbers[own] @ part.T).astype(np.int64)
                    if exclude:
                        scores[ids[own][:, None] == candidates[a:b]] = SMALLEST
                    best.add(own, scores, candidates[a:b])
        found = (best.scores > SMALLEST) & (best.scores >= floor[:, None])
        which = np.nonzero(found)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[which]), pa.array(best.ids[found]), pa.array(best.scores[found])], ["query_id", "vec_id", "score"]
        )

    return map_arrow(table, run, "query_id long, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows per query: first of every task's rows, then of what is left."""
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def first_floor(index: Index, ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """A score that the k-th best of each query reaches for certain: its k-th best in a bounded sample of the index."""
    rows = sampled(index.table, SAMPLE, index.rows)
    candidates, v = np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows], np.int64)
    floor = np.full(len(ids), SMALLEST)
    if len(rows) > k:
        for i in range(0, len(ids), 1024):
            scores = vectors[i : i + 1024].astype(np.int64) @ v.T
            scores[ids[i : i + 1024][:, None] == candidates] = SMALLEST
            floor[i : i + 1024] = np.partition(scores, -k, axis=1)[:, -k]
    return floor


def query_blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list = []
    for row in queries.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield np.array([r["vec_id"] for r in held]), np.array([r["v"] for r in held], np.int64)
            held = []
    if held:
        yield np.array([r["vec_id"] for r in held]), np.array([r["v"] for r in held], np.int64)


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id is divisible by `every`, its own id excluded."""
    rows = quantised(vectors)
    index = Index(rows, pivots)
    schema = "query_id long, rank int, vec_id long, score long"
    spark = vectors.sparkSession
    if not index.dimension:
        return spark.createDataFrame([], schema)
    queries = index.table.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("v").alias("v"))
    parts = []
    for ids, v in query_blocks(queries, block):
        found = searched(index, index.table, ids, v, first_floor(index, ids, v, k), k, True)
        parts.append(settle(best_of(found, k), "nearest"))
    if not parts:
        return spark.createDataFrame([], schema)
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
