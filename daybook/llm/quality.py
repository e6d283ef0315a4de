"""Quality of a text by a small convolutional network over its bytes, in numpy.

The whole text is cut into overlapping chunks. In every chunk learned filters run over the bytes (each
filter has a table with a weight for every byte at every place it looks at) and keep their largest
response; the responses of a text's chunks are combined as their mean, maximum and minimum, and one linear
layer makes them a probability. Everything is learned together by gradient descent on labelled texts.

Learning reads a bounded sample: at most `ROWS` labelled rows with the smallest hash of their doc_id, and of
each at most `CHUNKS` evenly spread chunks. It is fitted on the driver. Scoring reads all chunks of all
texts, batch by batch in the tasks; a document never leaves its task and the network (some 100 KB) is the only
thing sent out.

Defined cases: null and empty texts are one chunk of zero bytes and get its score. Labels that are null
are not learned from; several labels of one document, or rows of one doc_id, each count as rows. Without
any usable label, or with one class only, every text gets the score 1.0 (the only class 0: 0.0).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import as_bytes, map_arrow, slices

#: Bounds of the sample that is learned from.
ROWS, CHUNKS = 4096, 8
CHUNK, OVERLAP = 256, 64
#: Bytes a filter looks at, how far it moves, and how many filters there are.
WIDTH, STRIDE, FILTERS = 5, 2, 32
#: Steps of learning, texts in a step.
STEPS, BATCH, RATE, DECAY = 600, 64, 0.01, 1e-5
ACCEPTED = 0.7
#: Rows of doc_id's checksum that are never learned from.
FOLDS, HELD_OUT = 4, 2
#: Chunks worked on at a time.
BLOCK = 2048


def fold(doc_id, folds: int = FOLDS):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def cut(text: bytes) -> list[bytes]:
    """All overlapping chunks of a text."""
    step = CHUNK - OVERLAP
    return [text[p : p + CHUNK] for p in range(0, max(1, len(text) - OVERLAP), step)]


def stacked(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts as rows of bytes (zero after the end), and the text of each."""
    rows = b"".join([c.ljust(CHUNK, b"\0") for chunks in texts for c in chunks])
    owner = np.repeat(np.arange(len(texts)), [len(chunks) for chunks in texts])
    return np.frombuffer(rows, np.uint8).reshape(-1, CHUNK), owner


@dataclass
class Network:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # 3 FILTERS: mean, max, min over the chunks
    offset: float
    constant: float | None = None

    def filtered(self, chunks: np.ndarray) -> np.ndarray:
        """The responses: chunks x places x FILTERS."""
        places = (CHUNK - WIDTH) // STRIDE + 1
        out = np.zeros((len(chunks), places, self.tables.shape[2]), np.float32)
        for k in range(WIDTH):
            out += self.tables[k][chunks[:, k : k + STRIDE * places : STRIDE]]
        return out

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        parts = [self.filtered(chunks[i : i + 64]).max(1) for i in range(0, len(chunks), 64)]
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        chunks, owner = stacked([cut(t) for t in texts])
        found = np.concatenate([self.pooled(chunks[i : i + BLOCK]) for i in range(0, len(chunks), BLOCK)])
        return logistic(combined(found, owner) @ self.weights.astype(np.float64) + self.offset)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def combined(found: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per text the mean, maximum and minimum of its chunks' responses (owner is ascending, without gaps)."""
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    counts = np.diff(np.r_[starts, len(owner)])[:, None]
    return np.hstack([
        np.add.reduceat(found, starts) / counts, np.maximum.reduceat(found, starts), np.minimum.reduceat(found, starts)
    ])


def learn(texts: list[list[bytes]], labels: np.ndarray, seed: int = 7, steps: int = STEPS) -> Network:
    """A network for texts given as chunks, by gradient descent (Adam) on the logistic loss; through a maximum or minimum only its argument learns."""
    if len(texts) == 0 or labels.min() == labels.max():
        return Network(*[np.zeros(1)] * 3, 0.0, float(labels[0]) if len(texts) else 1.0)
    random = np.random.default_rng(seed)
    prior = float(np.clip(labels.mean(), 0.01, 0.99))
    net = Network(
        random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        random.normal(0, 0.1, 3 * FILTERS).astype(np.float32),
        float(np.log(prior / (1 - prior))),
    )
    chunks, owner = stacked(texts)
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    names = ("tables", "bias", "weights", "offset")
    first, second = {n: 0.0 for n in names}, {n: 0.0 for n in names}
    step, epochs = 0, max(1, round(steps * BATCH / len(texts)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = random.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            batch = np.sort(order[i : i + BATCH])
            rows = np.concatenate([np.arange(starts[t], starts[t + 1]) for t in batch])
            own = np.repeat(np.arange(len(batch)), starts[batch + 1] - starts[batch])
            step += 1
            for name, slope in slopes(net, chunks[rows], own, labels[batch]).items():
                slope = slope + DECAY * getattr(net, name)
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                change = rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, (getattr(net, name) - change) if name == "offset" else (getattr(net, name) - change).astype(np.float32))
    net.offset = float(net.offset)
    return net


def slopes(net: Network, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the mean loss of one batch of texts."""
    place, top = [], []
    for i in range(0, len(chunks), 64):
        response = net.filtered(chunks[i : i + 64])
        place.append(response.argmax(1))
        top.append(response.max(1))
    place, top = np.concatenate(place), np.concatenate(top) + net.bias
    found = np.maximum(top, 0)
    features = combined(found, owner)
    error = (logistic(features @ net.weights + net.offset) - labels) / len(labels)
    back = (error[:, None] * net.weights).reshape(len(labels), 3, FILTERS)
    counts = np.bincount(owner)[:, None]
    down = (back[:, 0] / counts)[owner]
    for part, limit in ((1, features[:, FILTERS : 2 * FILTERS]), (2, features[:, 2 * FILTERS :])):
        reached = found == limit[owner]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        down = down + reached * (back[:, part] / np.maximum(np.add.reduceat(reached, starts, dtype=np.int64), 1))[owner]
    down = np.where(top > 0, down, 0).astype(np.float64)
    tables = np.zeros((WIDTH, 256, FILTERS))
    filters = np.broadcast_to(np.arange(FILTERS), place.shape)
    for k in range(WIDTH):
        byte = np.take_along_axis(chunks, place * STRIDE + k, 1).astype(np.int64)
        tables[k] = np.bincount((byte * FILTERS + filters).ravel(), down.ravel(), 256 * FILTERS).reshape(256, FILTERS)
    return {"tables": tables, "bias": down.sum(0), "weights": features.T @ error, "offset": error.sum()}


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Network:
    """Learns from the sample; only its chunks come to the driver."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).where(fold(F.col("doc_id")) != HELD_OUT)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = (
        known.join(named, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    step = CHUNK - OVERLAP
    data = texts.join(F.broadcast(chosen), "doc_id")  # at most `rows` rows of two numbers
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    n = F.greatest(F.lit(1), F.ceil((F.length("raw") - OVERLAP) / step))
    spread = F.transform(
        F.sequence(F.lit(0), F.least("n", F.lit(CHUNKS)).cast("int") - 1),
        lambda i: F.when(F.col("n") <= CHUNKS, i).otherwise(F.floor(i * (F.col("n") - 1) / (CHUNKS - 1))).cast("int"),
    )
    parts = (
        data.select("doc_id", "quality", raw.alias("raw"))
        .withColumn("n", n)
        .select("doc_id", "quality", F.transform(spread, lambda p: F.substring(F.col("raw"), p * step + 1, F.lit(CHUNK))).alias("chunks"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "chunks")
        .limit(rows)
        .collect()
    )
    return learn([list(map(bytes, r["chunks"])) for r in parts], np.array([float(r["quality"] == 1) for r in parts]))


def scores(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = net.score(as_bytes(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")


def judged(found: DataFrame, accepted: float = ACCEPTED) -> DataFrame:
    """The contract's columns of what `scores` gives."""
    return found.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= accepted).cast("int").alias("predicted"),
    )


def accept(docs: DataFrame, net: Network, accepted: float = ACCEPTED) -> DataFrame:
    """The documents whose own text is accepted, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(net.score(as_bytes(batch)) >= accepted))

    return map_arrow(docs, run, docs.schema)
