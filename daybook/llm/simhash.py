"""Near-duplicate detection by SimHash fingerprints and an inverted index over their byte positions.

A fingerprint has eight bytes. Two that differ in at most three bits differ in at most three bytes, so at
least five bytes agree in value and place: that is the guaranteed minimum of matches. The index posts
every distinct fingerprint under its byte positions, five of eight at a time (56 lists of 40-bit keys), so
that a pair reaches the minimum exactly if it meets in a list: counting shared bytes and keeping the pairs
with five or more is done by the key instead of by writing out all pairs with one byte in common. What
meets is verified by its differing bits.

Scale: equal texts collapse to one fingerprint before anything else. A list holds distinct fingerprints
that agree in 40 bits, thus never a hot value; inside a list only the links that connect it are written
(at most one per member), so a group of near copies does not grow into its square. Components are found
by joins on the fingerprints; nothing is collected.

Defined cases: null and empty texts have no words and the fingerprint 0, linked like any other.
Rows with the same doc_id are separate documents of one id, and may have different fingerprints. Rows
without doc_id get the component of their fingerprint, but give it no id; a component of only such rows
has a null component_id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import as_bytes, fresh, map_arrow, settle, slices
from daybook.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
POSITIONS = 8
#: The bytes of two fingerprints within MAX_BITS that agree for certain.
MIN_SHARED = POSITIONS - MAX_BITS
SEED = 42
#: Hashes whose bits are counted at a time, and members of a list compared at a time.
HASHES, BLOCK = 1 << 16, 1 << 14


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64 bits; each is set if it is set in over half of the shingles' hashes."""
    found = text.lower().split()  # on bytes: only A-Z and the six white-space characters
    if not found:
        return 0
    digest, n = xxhash.xxh64_intdigest, max(1, len(found) - words + 1)
    hashes = np.fromiter(
        (digest(b" ".join(found[i : i + words]), SEED) for i in range(n)) if n > 1 else [digest(b" ".join(found), SEED)],
        np.uint64,
        n,
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, n, HASHES):
        ones += np.unpackbits(hashes[i : i + HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, name: str = "fingerprint", words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, a 64-bit hash of the text that tells rows of one id apart, and the fingerprint (signed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, words) for t in as_bytes(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found)], ["doc_id", "text_hash", name])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, {name} long")


def spanning(members: np.ndarray, max_bits: int = MAX_BITS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links within max_bits that connect all members that any such links connect, each member reached once.

    A breadth-first search; a member once reached is compared no more, so a dense group costs about as
    many comparisons as it has members.
    """
    left, right = [], []
    rest = members
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = np.zeros(len(rest), bool)
            for i in range(0, len(rest), BLOCK):
                near[i : i + BLOCK] = np.bitwise_count(rest[i : i + BLOCK] ^ at) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(np.full(len(found), at))
                right.append(found)
                reached += list(found)
    return left, right


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """src < dst: links that connect the distinct fingerprints (a column `fingerprint`) as all links within max_bits do."""
    shared = POSITIONS - max_bits
    subsets = list(combinations(range(POSITIONS), shared))

    keys = F.array(*[
        F.struct(F.lit(k).cast("byte").alias("list"), F.col("fingerprint").bitwiseAND(F.lit(mask_of(s))).alias("shared"))
        for k, s in enumerate(subsets)
    ])
    posted = prints.select("fingerprint", F.explode(keys).alias("key")).select("key.list", "key.shared", "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        batches = iter(batches)
        more = True
        while more:
            batch = next(batches, None)
            more = batch is not None
            if more:
                got = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                held = [np.concatenate([h, g.astype(h.dtype) if h.dtype != np.uint64 else g.view(np.uint64)]) for h, g in zip(held, got, strict=True)]
            new = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])) + 1
            last = (int(new[-1]) if len(new) else 0) if more else len(held[0])
            starts = np.r_[0, new[new < last], last] if last else np.zeros(0, np.int64)
            left, right = [], []
            sizes = np.diff(starts)
            twos = starts[:-1][sizes == 2] if len(sizes) else np.zeros(0, np.int64)
            a, b = held[2][twos], held[2][twos + 1] if len(twos) else held[2][:0]
            near = np.bitwise_count(a ^ b) <= max_bits
            left.append(a[near])
            right.append(b[near])
            for i in np.flatnonzero(sizes > 2):
                more_left, more_right = spanning(held[2][starts[i] : starts[i + 1]], max_bits)
                left += more_left
                right += more_right
            held = [h[last:] for h in held]
            a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["src", "dst"])

    ordered = posted.repartition("list", "shared").sortWithinPartitions("list", "shared")
    return map_arrow(ordered, run, "src long, dst long").distinct()


def mask_of(positions: tuple[int, ...]) -> int:
    """The mask of these bytes as a signed 64-bit number."""
    mask = sum(255 << 8 * p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def classes(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint (signed), root (the smallest fingerprint reachable)."""
    prints = settle(fingerprints(docs, words=words), "fingerprints")
    distinct = prints.select("fingerprint").distinct()
    linked = components(settle(links(distinct, max_bits), "links"))
    return prints.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )


def component_ids(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id of the component."""
    found = settle(classes(docs, words, max_bits), "classes")
    smallest = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(smallest, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one row of each component: the smallest doc_id (null: last), then the smallest text hash."""
    found = classes(docs, words, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    kept = settle(found.groupBy("root").agg(first).select("first.doc_id", "first.text_hash"), "kept")
    text_hash = fresh("text_hash", docs.columns)
    named = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    rows = docs.withColumn(text_hash, F.xxhash64("text"))
    rows = rows.join(named, rows["doc_id"].eqNullSafe(named["kept_id"]) & (rows[text_hash] == named["kept_hash"]), "left_semi")
    return rows.dropDuplicates(["doc_id", text_hash]).drop(text_hash)
