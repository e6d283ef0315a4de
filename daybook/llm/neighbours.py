"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

The rows are dealt evenly to shards of a bounded number of rows. A shard's graph has layers: each node is in the
bottom layer, one of `THIN` in the layer above, and so on. In every layer a node has a fixed number of places for its
neighbours, so a layer is two flat arrays, its nodes and their neighbours. Candidates for neighbours are the
nearest nodes of the layer and of the thinner layers above (which give long links); of these a node keeps
those that are nearer to it than to a neighbour kept before, then, while places are left, the nearest others. Links are
offered in the other direction too, and chosen again by the same rule. Distances are those of vectors
lifted by one component to equal length, which order by inner product.

The index is a written table with one row per shard: ids, vectors and the layers as binary arrays. A search
starts from the whole top layer, descends with a few best nodes, and keeps the `BEAM` best nodes of the bottom layer
until all of them have been expanded; many queries take each step together. Found nodes are scored once
more in double precision, component by component, so equal vectors have equal scores in all shards. The best of
every shard are merged by an aggregation per query.

Equal vectors of a shard are one node with a list of ids, so copies neither fill the neighbour lists nor the beam,
however many there are.

Scale: tasks hold one shard and one block of queries; the query set is a written table that tasks read block by
block, so nothing passes through the driver. Each query visits every shard, and in it a number of nodes that grows with
the logarithm of the shard. A graph is built with products of all pairs of its nodes, in blocks: the shard's
size bounds that. All rows are indexed.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components take no part; shorter ones
count as if zeros followed. Rows of equal id are separate candidates with equal id, and a query skips all rows
of its own id; a repeated query id is searched once, for its greatest vector. Rows without id take no part.
Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, settle
from daybook.llm.vectors import blocks, dots, finite, padded, stored

EVERY, K = 20, 20
#: Rows of a shard, and its vector components at most.
ROWS, VALUES = 16_384, 1 << 22
#: Neighbours in the bottom layer (half as many above), candidates for them, one in so many nodes is in the next layer.
LINKS, CANDIDATES, THIN = 32, 48, 16
#: A layer of so few nodes is the top.
TOP = 64
#: Nodes a query keeps in the bottom layer and above it, nodes it expands in a step, queries of a block.
BEAM, NARROW, STEP, BLOCK = 128, 12, 4, 512
INDEX = "ids binary, counts binary, starts binary, vectors binary, layer_nodes array<binary>, layer_links array<binary>"


def usable(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """vec_id and v (array of double) of the rows that take part."""
    some = F.exists(F.col(vector), lambda x: x != 0)
    return rows.where(F.col(row_id).isNotNull() & finite(vector) & some).select(
        F.col(row_id).cast("long").alias("vec_id"), F.transform(vector, lambda x: x.cast("double")).alias("v")
    )


def squares(points: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", points, points)


def nearest(points: np.ndarray, of: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """For each node of `of` its n nearest nodes of `among`, not itself; -1 where there are fewer."""
    n = min(n, len(among) - 1)
    out = np.full((len(of), max(n, 0)), -1, np.int32)
    if n < 1:
        return out
    base = points[among]
    half = squares(base) / 2
    for i in range(0, len(of), 256):
        some = of[i : i + 256]
        away = half - points[some] @ base.T
        away[some[:, None] == among] = np.inf
        out[i : i + 256] = among[np.argpartition(away, n - 1, axis=1)[:, :n]]
    return out


def choose(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, n: int) -> np.ndarray:
    """n neighbours of every node: spread candidates first, then the nearest others; -1 where there are fewer."""
    out = np.full((len(of), n), -1, np.int32)
    for i in range(0, len(of), 256):
        own, some = points[of[i : i + 256]], np.sort(candidates[i : i + 256], axis=1)
        some[:, 1:][some[:, 1:] == some[:, :-1]] = -1
        around = points[some]
        away = ((around - own[:, None]) ** 2).sum(2)
        away[some < 0] = np.inf
        order = np.argsort(away, axis=1, kind="stable")
        some, away = np.take_along_axis(some, order, 1), np.take_along_axis(away, order, 1)
        around = np.take_along_axis(around, order[:, :, None], 1)
        length = (around**2).sum(2)
        between = length[:, :, None] + length[:, None, :] - 2 * around @ around.transpose(0, 2, 1)
        kept = np.zeros(some.shape, bool)
        for j in range(some.shape[1]):
            hidden = (kept[:, :j] & (between[:, j, :j] <= away[:, j, None])).any(1)
            kept[:, j] = ~hidden & (some[:, j] >= 0)
        # the kept ones first, both kinds by distance
        turn = np.argsort(~kept, axis=1, kind="stable")[:, :n]
        out[i : i + 256, : turn.shape[1]] = np.take_along_axis(some, turn, 1)
    return out


def with_back_links(points: np.ndarray, nodes: np.ndarray, links: np.ndarray, candidates: int) -> np.ndarray:
    """The links of both directions per node, the nearest `candidates` of them; -1 where there are fewer."""
    start, end = np.repeat(nodes, links.shape[1]), links.ravel()
    there = end >= 0
    start, end = start[there].astype(np.int64), end[there].astype(np.int64)
    both = np.unique(np.r_[start * len(points) + end, end * len(points) + start])
    start, end = both // len(points), both % len(points)
    away = ((points[start] - points[end]) ** 2).sum(1)
    order = np.lexsort((away, start))
    start, end = start[order], end[order]
    row = np.searchsorted(nodes, start)
    place = np.arange(len(start)) - np.searchsorted(start, start)
    out = np.full((len(nodes), candidates), -1, np.int32)
    near = place < candidates
    out[row[near], place[near]] = end[near]
    return out


class Graph:
    """One shard: nodes are its different vectors; node i has the ids from starts[i] on, each with its number of rows."""

    def __init__(self, ids, counts, starts, vectors, layers):
        self.ids, self.counts, self.starts, self.vectors, self.layers = ids, counts, starts, vectors, layers
        self.small = vectors.astype(np.float32)  # for finding the way; scores come from `vectors`

    @classmethod
    def build(cls, row_ids: np.ndarray, rows: np.ndarray) -> Graph:
        vectors, node = np.unique(rows + 0.0, axis=0, return_inverse=True)  # no negative zeros
        pairs, counts = np.unique(np.stack([node.ravel(), row_ids], 1), axis=0, return_counts=True)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(vectors) + 1))
        length = squares(vectors)
        points = np.hstack([vectors, np.sqrt(np.maximum(length.max() - length, 0))[:, None]]).astype(np.float32)
        level = (-np.log(1 - np.random.default_rng(len(vectors)).random(len(vectors))) / np.log(THIN)).astype(int)
        layers, nodes = [], [np.arange(len(vectors))]
        while len(nodes[-1]) > TOP and (level >= len(nodes)).any():
            nodes.append(np.flatnonzero(level >= len(nodes)))
        for height, here in enumerate(nodes):
            n = LINKS if height == 0 else LINKS // 2
            wide = [nearest(points, here, above, CANDIDATES if i == 0 else 8) for i, above in enumerate(nodes[height:])]
            links = choose(points, here, np.hstack(wide), n)
            links = choose(points, here, with_back_links(points, here, links, CANDIDATES + n), n)
            layers.append((here.astype(np.int32), links))
        return cls(pairs[:, 1], counts, starts, vectors, layers)

    def beam(self, layer: int, queries: np.ndarray, entry: np.ndarray, width: int) -> np.ndarray:
        """The best `width` nodes of a layer per query (-1: none), reached from the entry nodes."""
        nodes, links = self.layers[layer]
        n, rows = len(queries), np.arange(len(queries))[:, None]
        seen = np.zeros((n, len(self.small) + 1), bool)  # the last column is for -1
        seen[rows, entry] = True
        seen[:, -1] = True
        held = np.full((n, width), -1, np.int32)
        scores = np.full((n, width), -np.inf, np.float32)
        entries = entry[:, :width]
        held[:, : entries.shape[1]] = entries
        scores[:, : entries.shape[1]] = np.einsum("qmd,qd->qm", self.small[entries], queries)
        scores[held < 0] = -np.inf
        waiting = held >= 0
        going = np.arange(n)
        while True:
            going = going[waiting[going].any(1)]
            if not len(going):
                return held
            ahead = np.where(waiting[going], scores[going], -np.inf)
            turn = np.argpartition(-ahead, min(STEP, width) - 1, axis=1)[:, :STEP]
            ready = np.take_along_axis(ahead, turn, 1) > -np.inf
            at = np.where(ready, np.take_along_axis(held[going], turn, 1), -1)
            waiting[going[:, None], turn] = False
            found = links[np.searchsorted(nodes, np.maximum(at, 0))]
            found[~ready] = -1
            found = np.sort(found.reshape(len(going), -1), axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found[seen[going[:, None], found]] = -1
            # in most rows few are new: keep only as many columns as any row needs
            fresh = found >= 0
            most = int(fresh.sum(1).max())
            if not most:
                continue
            found = np.take_along_axis(found, np.argsort(~fresh, axis=1, kind="stable")[:, :most], 1)
            seen[going[:, None], found] = True
            new = np.einsum("qmd,qd->qm", self.small[found], queries[going])
            new[found < 0] = -np.inf
            all_scores = np.hstack([scores[going], new])
            top = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
            scores[going] = np.take_along_axis(all_scores, top, 1)
            held[going] = np.take_along_axis(np.hstack([held[going], found]), top, 1)
            waiting[going] = np.take_along_axis(np.hstack([waiting[going], found >= 0]), top, 1)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, vec_id, score) of the k best rows of the shard found for each query, its own id left out."""
        small = queries.astype(np.float32)
        top = self.layers[-1][0]
        scores = small @ self.small[top].T
        best = top[np.argsort(-scores, axis=1)[:, :NARROW]]
        for layer in range(len(self.layers) - 2, 0, -1):
            best = self.beam(layer, small, best, NARROW)
        best = self.beam(0, small, best, beam)
        query, place = np.nonzero(best >= 0)
        node = best[query, place]
        exact = dots(self.vectors[node], queries[query])
        # of a node the k smallest ids other than the query's own are enough
        each = np.minimum(self.starts[node + 1] - self.starts[node], k + 1)
        row = np.repeat(np.arange(len(node)), each)
        at = self.starts[node][row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        other = self.ids[at] != ids[query[row]]
        row, at = row[other], at[other]
        copies = np.minimum(self.counts[at], k)
        row, at = np.repeat(row, copies), np.repeat(at, copies)
        order = np.lexsort((self.ids[at], -exact[row], query[row]))
        row, at = row[order], at[order]
        first = np.searchsorted(query[row], query[row])
        kept = np.arange(len(row)) - first < k
        return query[row[kept]], self.ids[at[kept]], exact[row[kept]]

    def packed(self) -> pa.RecordBatch:
        def raw(a, kind):
            return np.ascontiguousarray(a, kind).tobytes()

        flat = [raw(self.ids, "<i8"), raw(self.counts, "<i8"), raw(self.starts, "<i8"), raw(self.vectors, "<f8")]
        lists = [[raw(nodes, "<i4") for nodes, _ in self.layers], [raw(links, "<i4") for _, links in self.layers]]
        names = [c.split()[0] for c in INDEX.split(", ")]
        columns = [pa.array([x], pa.binary()) for x in flat] + [pa.array([x], pa.list_(pa.binary())) for x in lists]
        return pa.RecordBatch.from_arrays(columns, names)

    @classmethod
    def unpacked(cls, row: dict) -> Graph:
        starts = np.frombuffer(row["starts"], "<i8")
        layers = []
        for nodes, links in zip(row["layer_nodes"], row["layer_links"], strict=True):
            here = np.frombuffer(nodes, "<i4")
            layers.append((here, np.frombuffer(links, "<i4").reshape(len(here), -1)))
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(starts) - 1, -1)
        return cls(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["counts"], "<i8"), starts, vectors, layers)


def build(rows: DataFrame, width: int, shards: int) -> DataFrame:
    """The index over vec_id and v: one row per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # one shard
        if sum(b.num_rows for b in held):
            ids = np.concatenate([b.column("vec_id").to_numpy() for b in held])
            yield Graph.build(ids, np.vstack([padded(b.column("v"), width) for b in held])).packed()

    return settle(map_arrow(rows.repartition(shards), run, INDEX), "graphs")


def search(index: DataFrame, queries: DataFrame, width: int, k: int, beam: int = BEAM) -> DataFrame:
    """query_id, vec_id, score: of every shard the k best rows found for each query (vec_id, v)."""
    path = stored(queries, "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                graph = Graph.unpacked(batch.slice(i, 1).to_pylist()[0])
                for block in blocks(path, BLOCK):
                    ids = block.column("vec_id").to_numpy()
                    which, found, scores = graph.search(ids, padded(block.column("v"), width), k, beam)
                    columns = [pa.array(ids[which]), pa.array(found), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return map_arrow(index, run, "query_id long, vec_id long, score double")


def neighbours(vectors: DataFrame, every: int = EVERY, k: int = K, rows: int = ROWS, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose id is divisible by `every`."""
    known = usable(vectors)
    size = known.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width")).first()
    if not size["rows"]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    per_shard = max(1, min(rows, VALUES // size["width"]))
    index = build(known, size["width"], ceil(size["rows"] / per_shard))
    queries = known.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("v").alias("v"))
    found = search(index, queries, size["width"], k, max(beam, 2 * k))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
