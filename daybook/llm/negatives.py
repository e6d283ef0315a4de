"""Hard negatives: rows of another label whose inner product with an anchor lies in a window under a positive's.

The rows are packed into R-trees by sorting and tiling: ranges of (label, first component) go to tasks, and
each task cuts its rows into tiles by label and then by the components that vary most, down to leaves of `LEAF` rows.
A node of the tree is the smallest box around its rows, with the range of their labels and their smallest id. With the
parts of an anchor above and below zero, a box gives an interval for the inner product of every row in it, one
coordinate after the other. An anchor takes nodes from a queue, the one with the largest possible product first, and leaves
out nodes whose interval misses all its windows, whose labels cannot serve, or whose bound is strictly below the
k-th score of every window (at that score: if all its ids are larger).

Two searches use the same trees: the positives of an anchor, one window without limits over its own label, then the
negatives, one window per positive over other labels. The best of every task are merged by an aggregation.

Scale: the packed rows are a written table; the anchors are written too, ordered by label, and tasks read them a
block at a time and skip blocks whose labels they do not hold. Nothing passes through the driver. A task holds one
range of at most about `VALUES` components and one block of anchors. A label or vector that fills a third of the table
is spread over ranges, since these are cut by id in the end.

Defined cases: rows without id or label, with a null or empty vector, or with a null or non-finite component
take no part; shorter vectors count as if zeros followed. Rows of equal id are separate candidates with equal
id; an anchor skips all rows of its own id; a repeated anchor id is used once, with its greatest label and vector. Ties
go to the smaller id. Scores are whole numbers, exact below 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, settle
from daybook.llm.vectors import blocks, finite, padded, stored

SCALE = 256
EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: A negative's score is at least half and at most 95 hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
#: Rows of a leaf, nodes under a node, components of a task's rows, anchors of a block.
LEAF, FAN, VALUES, BLOCK = 128, 16, 1 << 24, 2048
#: Components that rows are tiled by, besides the label.
TILED = 3
FAR = np.iinfo(np.int64).max


def quantised(rows: DataFrame, label: Column, vector: str = "embedding", row_id: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id, label and v (whole parts of the scaled components) of the rows that take part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    named = rows.select(F.col(row_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias(vector))
    return named.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(vector)).select("vec_id", "label", whole.alias("v"))


def leaves(order: np.ndarray, keys: list[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """The rows of `order` in leaves: sorted by the first key and cut into slabs, each slab by the next key, and so on."""
    order = order[np.argsort(keys[0][order], kind="stable")]
    pages = ceil(len(order) / size)
    slabs = ceil(pages ** (1 / len(keys)))
    rows = size * ceil(pages / slabs)
    for i in range(0, len(order), rows):
        part = order[i : i + rows]
        if len(keys) == 1 or len(part) <= size:
            yield from (part[j : j + size] for j in range(0, len(part), size))
        else:
            yield from leaves(part, keys[1:], size)


class Level:
    """Boxes side by side: bounds per coordinate, labels, smallest ids, and where each one's children (or rows) start."""

    def __init__(self, low, high, label_low, label_high, least, starts):
        self.low, self.high, self.label_low, self.label_high, self.least, self.starts = low, high, label_low, label_high, least, starts


class Tree:
    """The R-tree of one task's rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        varied = np.argsort(-v.astype(np.float64).var(0), kind="stable")[:TILED]
        cut = list(leaves(np.arange(len(ids)), [labels, *[v[:, c] for c in varied]], leaf))
        order = np.concatenate(cut)
        self.ids, self.labels, self.v = ids[order], labels[order], v[order]
        starts = np.cumsum([0, *map(len, cut)])
        self.levels = [self.boxes(starts, self.v, self.v, self.labels, self.labels, self.ids)]
        while len(self.levels[-1].starts) > fan + 1:
            under = self.levels[-1]
            n = len(under.starts) - 1
            starts = np.r_[np.arange(0, n, fan), n]
            self.levels.append(self.boxes(starts, under.low, under.high, under.label_low, under.label_high, under.least))

    @staticmethod
    def boxes(starts, low, high, label_low, label_high, least) -> Level:
        at = starts[:-1]
        return Level(
            np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(label_low, at),
            np.maximum.reduceat(label_high, at), np.minimum.reduceat(least, at), starts,
        )

    @property
    def label_range(self) -> tuple[int, int]:
        top = self.levels[-1]
        return int(top.label_low.min()), int(top.label_high.max())

    def search(self, own: int, label: int, q: np.ndarray, windows: list[tuple[int, int]], k: int, same: bool) -> list[list[tuple[int, int]]]:
        """For every window of scores its k best rows (score, id) of the anchor's label, or of others."""
        above, below = np.maximum(q, 0), np.minimum(q, 0)
        best: list[list[tuple[int, int]]] = [[] for _ in windows]  # of (-score, id), the best first
        lowest, highest = min(w[0] for w in windows), max(w[1] for w in windows)
        queue: list[tuple] = []

        def intervals(level: int, first: int, last: int) -> Iterator[tuple]:
            boxes = self.levels[level]
            low, high = boxes.low[first:last], boxes.high[first:last]
            upper, lower = high @ above + low @ below, low @ above + high @ below
            a, b = boxes.label_low[first:last], boxes.label_high[first:last]
            fits = (a <= label) & (label <= b) if same else (a != label) | (b != label)
            for i in np.flatnonzero(fits & (upper >= lowest) & (lower <= highest)).tolist():
                yield -min(int(upper[i]), highest), level, first + i, int(lower[i])

        def useful(bound: int, lower: int, least: int) -> bool:
            for (low, high), found in zip(windows, best, strict=True):
                top = min(bound, high)
                if top >= low and lower <= high and (len(found) < k or (-top, least) < found[-1]):
                    return True
            return False

        queue.extend(intervals(len(self.levels) - 1, 0, len(self.levels[-1].starts) - 1))
        heapify(queue)
        while queue:
            key, level, node, lower = heappop(queue)
            boxes = self.levels[level]
            if not useful(-key, lower, int(boxes.least[node])):
                continue
            first, last = int(boxes.starts[node]), int(boxes.starts[node + 1])
            if level:
                for entry in intervals(level - 1, first, last):
                    heappush(queue, entry)
                continue
            scores, ids = self.v[first:last] @ q, self.ids[first:last]
            serves = (self.labels[first:last] == label) == same
            # no window takes a score under its lower end or under its k-th best
            needed = min(max(low, -found[-1][0]) if len(found) == k else low for (low, _), found in zip(windows, best, strict=True))
            near = np.flatnonzero(serves & (ids != own) & (scores >= needed) & (scores <= highest))
            if not len(near):
                continue
            scores, ids = scores[near].astype(np.int64), ids[near]
            for w, (low, high) in enumerate(windows):
                inside = (scores >= low) & (scores <= high)
                if inside.any():
                    new = sorted(zip((-scores[inside]).tolist(), ids[inside].tolist(), strict=True))[:k]
                    best[w] = sorted(best[w] + new)[:k]
        return [[(-s, i) for s, i in found] for found in best]


class Packed:
    """The written table of rows in ranges of (label, first component, id), one R-tree per range (several, if it has more rows than planned)."""

    def __init__(self, rows: DataFrame, width: int, exact: bool, tasks: int, most: int):
        self.width, self.exact, self.most = width, exact, most
        spread = ["label", F.get("v", F.lit(0)), "vec_id"]
        self.table = settle(rows.repartitionByRange(tasks, *spread), "packed")

    def search(self, path: str, k: int, same: bool, windows) -> DataFrame:
        """anchor_id, place, vec_id, score: for each anchor written at `path`, and each of its windows (by place), the k
        best rows of every tree. windows: from a block of anchors to the list of windows of each."""
        width, kind, most = self.width, np.float64 if self.exact else np.int64, self.most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= most:
                    yield from searched(held)
                    held = []
            if sum(b.num_rows for b in held):
                yield from searched(held)

        def searched(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, labels = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("vec_id", "label"))
            tree = Tree(ids, labels, np.vstack([padded(b.column("v"), width, kind) for b in held]))
            first, last = tree.label_range
            for block in blocks(path, BLOCK):
                own, label = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
                serves = (first <= label) & (label <= last) if same else (first != label) | (last != label)
                if not serves.any():
                    continue
                v, wanted = padded(block.column("v"), width, kind), windows(block)
                out: list[tuple] = []
                for i in np.flatnonzero(serves).tolist():
                    if wanted[i]:
                        found = tree.search(int(own[i]), int(label[i]), v[i], wanted[i], k, same)
                        out += [(int(own[i]), place, row, score) for place, some in enumerate(found) for score, row in some]
                columns = zip(*out, strict=True) if out else ([], [], [], [])
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor_id", "place", "vec_id", "score"])

        return map_arrow(self.table, run, "anchor_id long, place int, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def everywhere(block: pa.RecordBatch) -> list[list[tuple[int, int]]]:
    return [[(-FAR, FAR)]] * block.num_rows


def under_positives(lowest: int, highest: int):
    """The window of every positive: lowest * p <= 100 * score <= highest * p, in whole numbers."""

    def windows(block: pa.RecordBatch) -> list[list[tuple[int, int]]]:
        # a negative positive score leaves a window without scores; it stays, so that places keep their meaning
        return [
            [(-(-lowest * p["score"] // 100), highest * p["score"] // 100) for p in positives]
            for positives in block.column("positives").to_pylist()
        ]

    return windows


def mine(
    rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    lowest: int = LOWEST, highest: int = HIGHEST, values: int = VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over vec_id, label and v (see `quantised`)."""
    spark = rows.sparkSession
    size = rows.agg(
        F.count("*").alias("rows"), F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("largest"),
    ).first()
    if not size["rows"]:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    # products of whole numbers are exact in floating point up to 2^53; beyond, long integers are used
    exact = size["width"] * size["largest"] ** 2 < 2**53
    tasks = max(ceil(size["rows"] * size["width"] / values), min(spark.sparkContext.defaultParallelism, ceil(size["rows"] / 1024)))
    packed = Packed(rows, size["width"], exact, tasks, max(1, values // size["width"]))
    anchors = packed.table.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max(F.struct("label", "v")).alias("row"))
    anchors = settle(anchors.select("vec_id", "row.*").repartitionByRange("label", "vec_id"), "anchors")

    found = packed.search(stored(anchors, "anchors"), positives, True, everywhere)
    nearest = best_of(found, positives).groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", F.col("vec_id").alias("id")))).alias("positives")
    )
    with_positives = settle(anchors.join(nearest, "vec_id").repartitionByRange("label", "vec_id"), "positives")

    found = packed.search(stored(with_positives, "windows"), negatives, False, under_positives(lowest, highest))
    pairs = with_positives.select(F.col("vec_id").alias("anchor_id"), F.inline("positives")).select(
        "anchor_id", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    best = best_of(found, negatives).select("anchor_id", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(pairs, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
