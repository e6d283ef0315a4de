"""Benchmark decontamination with suffix arrays over the training text.

The words of a batch of documents form one shard. Its suffix array sorts all positions by the words that
follow; every suffix of every benchmark item is searched in it by bisection, all at once in numpy. The two
neighbours of the place found give the longest verbatim match of that suffix and where it occurs; the range
of suffixes that begin with an item's window of 13 words gives all its occurrences, and their words are hit.

Only words that some item has get a number. Runs of such words shorter than the shortest window cannot
hold one and are left out of the array; this drops no match, since a match consists of item words only.

Windows of the same words have the same range, which is kept once, however often benchmark rows repeat it; ranges of
equal length are disjoint, so a text has at most 13 entries a word, one length in memory at a time. Items
are joined to the documents of a range a fixed number of pairs at a time.

Scale: a document's rows never leave its task, so there is no shuffle and no group. The benchmark is a written
table in the shared folder, which tasks read in blocks of a fixed number of words (whole items; a block holds more
only if a single item is longer), one after the other; nothing of it passes through the driver. A table of one
block is read and prepared once per task, a larger one once per 16 MB of text.

Defined cases: null and empty texts have no words, are not hit and not contaminated. Items without words
have no window. Rows of one item_id are one item, which occurs if a window of any of its rows does; rows
without item_id are one item that is counted, but has no id to list. Repeated documents each get their
row. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import vectors
from daybook.llm.common import as_bytes, map_arrow, slices

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20
#: Benchmark words in memory at a time.
BLOCK_WORDS = 200_000
#: Benchmark rows read at a time.
ROWS = 1024
#: Pairs of document and item in memory at a time, beyond those found.
PAIRS = 1 << 21
#: Bytes of documents per suffix array.
SHARD_BYTES = 16 << 20
#: A-Z to a-z; all that isn't a word (ASCII but digits and letters) to a blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Block:
    """Some items: their ids, their words as numbers (from 1), and the numbers of all words."""

    item_ids: list
    items: list[np.ndarray]
    numbers: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[object, bytes]]) -> Block:
        numbers: dict[bytes, int] = {}
        ids, items = [], []
        for item_id, text in rows:
            if found := words(text):
                ids.append(item_id)
                items.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in found], np.int64))
        return cls(ids, items, numbers)

    def shortest(self, window: int) -> int:
        return min((min(window, len(x)) for x in self.items), default=window)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """The positions of text sorted by the `depth` words that follow (prefix doubling); 0 ends a run."""
    rank, order, reach = text.astype(np.int64), np.arange(len(text)), 1
    while True:
        ahead = np.zeros(len(text), np.int64)
        if reach > 1:
            ahead[: -(reach // 2)] = rank[reach // 2 :]
        key = rank * (len(text) + int(rank.max(initial=0)) + 1) + ahead if reach > 1 else rank
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(len(text), np.int64)
        rank[order] = new + 1
        if reach >= depth or (len(new) and new[-1] + 1 == len(text)) or not len(text):
            return order
        reach *= 2


def words_at(text: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k-th word after each position; 0 beyond the end."""
    place = at + k
    return np.where(place < len(text), text[np.minimum(place, len(text) - 1)], 0)


def bisect(text: np.ndarray, order: np.ndarray, queries: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
    """The number of suffixes that come before each query (row of words), or that come before or begin with it."""
    low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = order[np.minimum(middle, len(order) - 1)]
        less, same = np.zeros(len(queries), bool), np.ones(len(queries), bool)
        for k in range(queries.shape[1]):
            within = same & (k < lengths)
            if not within.any():
                break
            word = words_at(text, at, k)
            less |= within & (word < queries[:, k])
            same &= ~within | (word == queries[:, k])
        ahead = (less | same) if upper else less
        low, high = np.where(open_ & ahead, middle + 1, low), np.where(open_ & ~ahead, middle, high)
    return low


def common_words(text: np.ndarray, at: np.ndarray, item_words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """How many words from `at` in text agree with the item words from start (to stop)."""
    length, going = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(going):
        k = length[going]
        inside = (start[going] + k < stop[going]) & (at[going] + k < len(text))
        going, k = going[inside], k[inside]
        equal = text[at[going] + k] == item_words[start[going] + k]
        going = going[equal]
        length[going] += 1
    return length


class Queries:
    """All suffixes of a block's items, with the windows among them."""

    def __init__(self, block: Block, window: int):
        sizes = np.array([len(x) for x in block.items], np.int64)
        self.words = np.concatenate(block.items) if block.items else np.zeros(0, np.int64)
        self.item = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)
        self.start = np.arange(len(self.words))
        self.stop = ends[self.item] if len(sizes) else self.start
        left = self.stop - self.start
        self.length = np.minimum(left, window)
        #: a window starts where 13 words are left, or at the head of a shorter item
        self.window = (left >= window) | ((sizes[self.item] < window) & (left == sizes[self.item])) if len(sizes) else left > 0
        self.rows = np.zeros((len(self.words), window), np.int64)
        for k in range(window):
            inside = k < self.length
            self.rows[inside, k] = self.words[self.start[inside] + k]


@dataclass
class Found:
    """What a shard holds: hit documents' places, and the longest match of each item suffix."""

    hit: np.ndarray  # per word of the shard's text
    pairs: tuple[np.ndarray, np.ndarray]  # document, item with a window in it; each pair once
    longest: tuple[np.ndarray, np.ndarray]  # per suffix: length, position


def steps(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each number n of a list its place n times, with 0 to n - 1."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)


def united(ranges: np.ndarray, docs: np.ndarray, items_from: np.ndarray, items: np.ndarray, n_items: int) -> np.ndarray:
    """document * n_items + item, each once, for pairs of a range and a document; a range's items lie between its two
    numbers in items_from."""
    count = np.diff(items_from)[ranges]
    cuts = np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1
    found = np.zeros(0, np.int64)
    for part in np.split(np.arange(len(ranges)), cuts):
        which, nth = steps(count[part])
        item = items[items_from[ranges[part]][which] + nth]
        found = np.union1d(found, docs[part][which] * n_items + item)
    return found


def search(text: np.ndarray, doc: np.ndarray, queries: Queries, window: int, deepest: bool = False) -> Found:
    """`doc`: the document of each word of the text."""
    order = suffix_array(text, int(max(window, (queries.stop - queries.start).max())) if deepest else window)
    low = bisect(text, order, queries.rows, queries.length, False)
    high = bisect(text, order, queries.rows, queries.length, True)
    longest, place = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
    for near in (low - 1, low):
        inside = (near >= 0) & (near < len(order))
        at = order[near[inside]]
        length = common_words(text, at, queries.words, queries.start[inside], queries.stop[inside])
        better = np.flatnonzero(inside)[length > longest[inside]]
        place[better] = at[length > longest[inside]]
        longest[inside] = np.maximum(longest[inside], length)

    held = np.flatnonzero(queries.window & (high > low))
    n_items, n_docs = int(queries.item[-1]) + 1, int(doc.max()) + 1
    ranges, which = np.unique(np.stack([queries.length[held], low[held], high[held]], axis=1), axis=0, return_inverse=True)
    of_range = np.unique(which.reshape(-1) * n_items + queries.item[held])
    items_from = np.searchsorted(of_range // n_items, np.arange(len(ranges) + 1))
    edge, pairs = np.zeros(len(text) + 1, np.int64), np.zeros(0, np.int64)
    for length in np.unique(ranges[:, 0]):
        own = np.flatnonzero(ranges[:, 0] == length)
        nth_range, nth = steps(ranges[own, 2] - ranges[own, 1])
        at = order[ranges[own, 1][nth_range] + nth]
        edge[:-1] += np.bincount(at, minlength=len(text))
        edge += np.bincount(at + length, minlength=len(edge)) * -1
        seen = np.unique(own[nth_range] * n_docs + doc[at])
        pairs = np.union1d(pairs, united(seen // n_docs, seen % n_docs, items_from, of_range % n_items, n_items))
    return Found(np.cumsum(edge[:-1]) > 0, (pairs // n_items, pairs % n_items), (longest, place))


def runs(numbers: np.ndarray, shortest: int) -> np.ndarray:
    """Which words lie in runs of item words (numbers above 0) at least that long."""
    known = np.r_[0, (numbers > 0).astype(np.int8), 0]
    turn = np.flatnonzero(np.diff(known))
    starts, stops = turn[::2], turn[1::2]
    enough = stops - starts >= shortest
    edge = np.zeros(len(numbers) + 1, np.int64)
    edge[starts[enough]] += 1
    edge[stops[enough]] -= 1
    return np.cumsum(edge[:-1]) > 0


class Shard:
    """The words of some documents as one text of word numbers; runs and documents are parted by 0."""

    def __init__(self, found: list[list[bytes]], block: Block, window: int):
        get, shortest = block.numbers.get, block.shortest(window)
        texts, docs, places = [np.zeros(1, np.int64)], [np.full(1, -1)], [np.zeros(1, np.int64)]
        for doc, own in enumerate(found):
            numbers = np.fromiter([get(w, 0) for w in own], np.int64, len(own))
            kept = np.flatnonzero(runs(numbers, shortest)) if len(own) else np.zeros(0, np.int64)
            if len(kept):
                at = np.arange(len(kept)) + np.cumsum(np.r_[False, np.diff(kept) > 1])
                row, place = np.zeros(at[-1] + 2, np.int64), np.zeros(at[-1] + 2, np.int64)
                row[at], place[at] = numbers[kept], kept
                texts.append(row)
                docs.append(np.full(len(row), doc))
                places.append(place)
        self.text, self.doc, self.place = map(np.concatenate, (texts, docs, places))


def written(benchmark: DataFrame) -> str:
    """The benchmark as files that tasks read; their path."""
    return vectors.stored(benchmark.select("item_id", "text"), "benchmark")


def blocks(path: str, size: int = BLOCK_WORDS) -> Iterator[Block]:
    """The written benchmark in blocks, in the same order for every reader."""
    held: list[tuple[object, bytes]] = []
    n = 0
    for batch in vectors.blocks(path, ROWS):
        for item_id, text in zip(batch.column("item_id").to_pylist(), as_bytes(batch), strict=True):
            held.append((item_id, text))
            n += len(words(text))
            if n >= size:
                yield Block.of(held)
                held, n = [], 0
    yield Block.of(held)


def prepared(path: str, window: int, size: int) -> Iterator[Iterator[tuple[Block, Queries]]]:
    """Each block with its suffixes, in turn, again and again; a single block is read and prepared once."""
    once: list[tuple[Block, Queries]] = []

    def round_() -> Iterator[tuple[Block, Queries]]:
        first, n = None, 0
        for block in blocks(path, size):
            ready, n = (block, Queries(block, window)), n + 1
            first = ready if n == 1 else None
            yield ready
        once.extend([first] if first else [])

    while True:
        yield iter(once) if once else round_()


class Detector:
    """Holds texts against all blocks of a written benchmark, one after the other."""

    def __init__(self, path: str, window: int, block_words: int):
        self.rounds, self.window = prepared(path, window, block_words), window

    def __call__(self, texts: list[bytes]) -> tuple[list[int], list[int], list[set]]:
        """Per text its words, its hit words, and the ids of the items whose windows occur."""
        found = [words(t) for t in texts]
        hit = [np.zeros(0, np.int64) for _ in found]
        items: list[set] = [set() for _ in found]
        for block, queries in next(self.rounds):
            shard = Shard(found, block, self.window)
            if len(shard.text) < 2 or not len(queries.words):
                continue
            result = search(shard.text, shard.doc, queries, self.window)
            for doc, i in zip(*(x.tolist() for x in result.pairs), strict=True):
                items[doc].add(block.item_ids[i])
            places = np.flatnonzero(result.hit)
            cut = np.flatnonzero(np.diff(shard.doc[places])) + 1
            for part in np.split(places, cut) if len(places) else ():
                doc = shard.doc[part[0]]
                hit[doc] = np.union1d(hit[doc], shard.place[part])
        return [len(f) for f in found], [len(h) for h in hit], items


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (the ids whose windows occur, as sorted strings), n_items."""
    path = written(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(path, window, block_words)
        for batch in slices(batches, size=SHARD_BYTES):
            n_words, n_hit, items = detector(as_bytes(batch))
            listed = [sorted(str(i) for i in own if i is not None) for own in items]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(listed, pa.list_(pa.string())),
                    pa.array([len(own) for own in items], pa.int64()),
                ],
                ["doc_id", "n_words", "n_hit", "items", "n_items"],
            )

    schema = "doc_id long, n_words long, n_hit long, items array<string>, n_items long"
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def judged(found: DataFrame) -> DataFrame:
    """The contract's columns of what `hits` gives."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        F.expr(f"n_hit > 0 AND {SHARE} * n_hit >= n_words").alias("contaminated"),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per item its longest verbatim match: item_id, item_word, n_words, doc_id, doc_word (ties: the smallest).

    Matches are as long as both texts agree, beyond the window; items without a common word have no row.
    """
    path = written(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = prepared(path, WINDOW, block_words)
        for batch in slices(batches, size=SHARD_BYTES):
            doc_ids, found = batch.column("doc_id").to_pylist(), [words(t) for t in as_bytes(batch)]
            for block, queries in next(rounds):
                shard = Shard(found, block, 1)
                if len(shard.text) > 1 and len(queries.words):
                    length, at = search(shard.text, shard.doc, queries, WINDOW, deepest=True).longest
                    rows = [
                        (str(block.item_ids[queries.item[i]]), int(i - starts), int(length[i]), doc_ids[shard.doc[at[i]]], int(shard.place[at[i]]))
                        for i, starts in best_suffixes(length, queries)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), MATCH_KINDS, strict=True)] if rows else [pa.array([], k) for k in MATCH_KINDS],
                        MATCH_NAMES,
                    )

    schema = "item_id string, item_word long, n_words long, doc_id long, doc_word long"
    found = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)
    best = F.max(F.struct("n_words", *[(-F.col(c)).alias(c) for c in ("doc_id", "doc_word", "item_word")])).alias("best")
    return found.groupBy("item_id").agg(best).select(
        "item_id", "best.n_words", *[(-F.col(f"best.{c}")).alias(c) for c in ("item_word", "doc_id", "doc_word")]
    )


MATCH_NAMES = ["item_id", "item_word", "n_words", "doc_id", "doc_word"]
MATCH_KINDS = [pa.string(), *[pa.int64()] * 4]


def best_suffixes(length: np.ndarray, queries: Queries) -> Iterator[tuple[int, int]]:
    """Of each item the suffixes with the longest match in this shard, with the item's first place."""
    firsts = np.flatnonzero(np.r_[True, queries.item[1:] != queries.item[:-1]])
    best = np.maximum.reduceat(length, firsts)
    for i in np.flatnonzero((length == best[queries.item]) & (length > 0)):
        yield i, firsts[queries.item[i]]


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that are not contaminated, with all their columns; every row is judged by its own text."""
    path = written(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(path, window, block_words)
        for batch in slices(batches, size=SHARD_BYTES):
            n_words, n_hit, _ = detector(as_bytes(batch))
            yield batch.filter(pa.array([not h or h * SHARE < n for h, n in zip(n_hit, n_words, strict=True)]))

    return map_arrow(docs, run, docs.schema)
