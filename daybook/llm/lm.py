"""Scores of texts by a log-bilinear neural language model, trained in numpy with noise-contrastive estimation.

Words are written as symbols: the end of a text, the most frequent words, and for all other words a class by
their last two bytes. The model predicts the next symbol: the vectors of the four symbols before, each
scaled by weights of its place, add up to a prediction, whose products with the symbols' own vectors (and a
bias) are the log-odds. Scoring normalises them over all symbols in batched matrix products; a word of
a class gets in addition its share of the class, from the counts of all training words, smoothed by 0.1 with one
place for words never seen. The probabilities of all words (and one unseen word per class) thus sum to one.

Everything is learned from all training texts. Word counts are one aggregation. Each task trains a copy of the
network, from the same start, on the texts of its partition, a slice at a time (a small slice several times); the
copies are averaged by their tokens in a second aggregation. Noise samples are shared by a batch.

Scale: the network has a fixed size (about 4,400 numbers), and so has the table of the `TABLE` most frequent words
that every task holds; the driver sees no more than these. All other words of a text, each at most one in
`TABLE` tokens, so never a hot key, are counted per text and joined with the table of counts.

Defined cases: null and empty texts are the end alone. A null doc_id is not learned from and counts as held out.
Repeated rows are learned from and scored as often as they occur. Without any training text every
score is that of the smoothed counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import as_bytes, map_arrow, settle, slices

FOLDS, HELD_OUT = 10, 0
SMOOTH = 0.1
#: Symbols: 0 is the end, then the words of their own, then the classes.
WORDS, CLASSES = 159, 96
SYMBOLS = 1 + WORDS + CLASSES
DEPTH, CONTEXT = 8, 4
#: Words in every task's table, words a task counts or keeps at a time.
TABLE, KEPT = 100_000, 300_000
BATCH, NOISE, RATE, STEPS = 2048, 32, 0.15, 300
#: Tokens normalised at a time.
BLOCK = 1024


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def word_class(word: bytes) -> int:
    return 1 + WORDS + zlib.crc32(word[-2:]) % CLASSES


class Symbols(dict):
    """The symbol of every word; classes are kept as they come, up to a bound."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT:
            self.clear()
            self.update(self.own)
        found = self[word] = word_class(word)
        return found


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, text (null: empty)."""
    doc_id = F.col("doc_id").cast("long")
    held_out = F.coalesce(fold(doc_id) == HELD_OUT, F.lit(True))
    return docs.select(doc_id.alias("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))


def count_words(rows: DataFrame) -> DataFrame:
    """word (binary), class, n over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in as_bytes(batch):
                counts.update(text.lower().split())  # on bytes: A-Z alone, and the six white-space characters
            if len(counts) > KEPT:
                yield counted(counts)
                counts = Counter()
        yield counted(counts)

    def counted(counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([word_class(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            ["word", "class", "n"],
        )

    found = map_arrow(rows.select("text"), run, "word binary, class int, n long")
    return found.groupBy("word", "class").agg(F.sum("n").alias("n"))


@dataclass
class Network:
    context: np.ndarray  # SYMBOLS x DEPTH
    place: np.ndarray  # CONTEXT x DEPTH
    target: np.ndarray  # SYMBOLS x DEPTH
    bias: np.ndarray  # SYMBOLS

    @classmethod
    def start(cls, share: np.ndarray, seed: int = 11) -> Network:
        random = np.random.default_rng(seed)
        return cls(
            random.normal(0, 0.3, (SYMBOLS, DEPTH)),
            np.full((CONTEXT, DEPTH), 1 / CONTEXT),
            random.normal(0, 0.1, (SYMBOLS, DEPTH)),
            np.log(share),
        ).cast(np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.place, self.target, self.bias]

    def cast(self, kind) -> Network:
        return Network(*[p.astype(kind) for p in self.parts()])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float64)

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        shapes = [(SYMBOLS, DEPTH), (CONTEXT, DEPTH), (SYMBOLS, DEPTH), (SYMBOLS,)]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return cls(*[p.reshape(s) for p, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)]).cast(np.float32)

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        out = self.context[contexts[:, 0]] * self.place[0]
        for i in range(1, CONTEXT):
            out += self.context[contexts[:, i]] * self.place[i]
        return out

    def log10(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """The normalised log10 probability of each target symbol."""
        out, across = np.empty(len(targets)), np.ascontiguousarray(self.target.T)
        for i in range(0, len(targets), BLOCK):
            odds = self.predicted(contexts[i : i + BLOCK]) @ across
            odds += self.bias
            own = odds[np.arange(len(odds)), targets[i : i + BLOCK]]
            top = odds.max(1, keepdims=True)
            odds -= top
            np.exp(odds, out=odds)
            out[i : i + BLOCK] = own - top[:, 0] - np.log(odds.sum(1))
        return out / np.log(10)


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and targets of all tokens: each text's symbols and its end; before a text the context is ends."""
    gap, end = np.zeros(CONTEXT, np.int16), np.zeros(1, np.int16)
    flat = np.concatenate([x for t in texts for x in (gap, t, end)])
    lengths = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(lengths + CONTEXT) - lengths - CONTEXT
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    first = np.repeat(starts, lengths) + within
    return np.stack([flat[first + i] for i in range(CONTEXT)], 1), flat[first + CONTEXT]


class Trainer:
    """One copy of the network, trained by noise-contrastive estimation (AdaGrad)."""

    def __init__(self, net: Network, share: np.ndarray, seed: int):
        self.net, self.random = net.cast(np.float32), np.random.default_rng(seed)
        self.edges, self.known = np.cumsum(share), np.log(NOISE * share).astype(np.float32)
        self.past = [np.full(p.shape, 1e-3, np.float32) for p in net.parts()]
        self.tokens = 0

    def learn(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        """All tokens once, or as often as gives the wanted number of steps."""
        self.tokens += len(targets)
        for _ in range(max(1, -(-STEPS * BATCH // len(targets)))):
            order = self.random.permutation(len(targets))
            for i in range(0, len(order), BATCH):
                at = order[i : i + BATCH]
                self.step(contexts[at], targets[at])

    def step(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        net, n = self.net, len(targets)
        noise = np.minimum(np.searchsorted(self.edges, self.random.random(NOISE)), SYMBOLS - 1)
        vectors = [net.context[contexts[:, i]] for i in range(CONTEXT)]
        guess = sum(v * net.place[i] for i, v in enumerate(vectors))
        own, other = net.target[targets], net.target[noise]
        # how far each sample is from being told right: data from noise, noise from data
        right = sigmoid(-((guess * own).sum(1) + net.bias[targets] - self.known[targets]))
        wrong = -sigmoid(guess @ other.T + net.bias[noise] - self.known[noise])
        down = right[:, None] * own + wrong @ other
        target, bias = scattered(targets, right[:, None] * guess), np.bincount(targets, right, SYMBOLS)
        np.add.at(target, noise, wrong.T @ guess)
        np.add.at(bias, noise, wrong.sum(0))
        context, place = 0, np.empty_like(net.place)
        for i, v in enumerate(vectors):
            context = context + scattered(contexts[:, i], down * net.place[i])
            place[i] = (down * v).sum(0)
        for slope, past, part in zip((context, place, target, bias), self.past, net.parts(), strict=True):
            slope = (slope / n).astype(np.float32)
            past += slope * slope
            part += RATE * slope / np.sqrt(past)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scattered(symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the rows of each symbol."""
    at = symbols.astype(np.int64)[:, None] * DEPTH + np.arange(DEPTH)
    return np.bincount(at.ravel(), rows.ravel(), SYMBOLS * DEPTH).reshape(SYMBOLS, DEPTH)


def train(rows: DataFrame, own: dict[bytes, int], share: np.ndarray) -> Network:
    """The average of the copies that the tasks train, weighted by their tokens."""
    start = Network.start(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(own).__getitem__
        trainer = Trainer(start, share, 5)
        for batch in slices(batches):
            texts = [np.array([*map(symbols, t.lower().split())], np.int16) for t in as_bytes(batch)]
            trainer.learn(*windows(texts))
        if trainer.tokens:
            flat = trainer.net.flat()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * trainer.tokens), pa.array(np.full(len(flat), float(trainer.tokens)))],
                ["place", "value", "weight"],
            )

    copies = map_arrow(rows.select("text"), run, "place long, value double, weight double")
    mean = copies.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value")).collect()
    flat = start.flat()
    for row in mean:
        flat[row["place"]] = row["value"]
    return Network.of(flat)


@dataclass
class Model:
    net: Network
    own: dict[bytes, int]
    table: dict[bytes, int]
    table_symbol: np.ndarray
    table_inside: np.ndarray  # log10 share of its symbol
    table_base: np.ndarray
    class_total: dict[int, float]  # what a class's counts are divided by
    ends: int
    tokens: int
    distinct: int

    @property
    def base_total(self) -> float:
        return self.tokens + SMOOTH * (self.distinct + 1)


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int, int]]:
    """The words of the highest counts as (word, class, n), by falling count: whole levels of counts, at most `most`.

    A level spans about a tenth of its counts, so there are a few hundred, whose sizes say where to cut; no
    task sends more than the words above the cut.
    """
    level = F.floor(F.log("n") * 10)
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    cut, held = None, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > most:
            break
        cut = at
    if cut is None:
        return []
    found = counts.where(level >= cut).collect()
    return sorted(((bytes(r["word"]), r["class"], r["n"]) for r in found), key=lambda w: (-w[2], w[0]))


def fit(rows: DataFrame, counts: DataFrame) -> Model:
    """The model of the training rows and their (written) word counts."""
    ends = rows.count()
    total = counts.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    top = frequent(counts, TABLE)
    own = {w: 1 + i for i, (w, _, _) in enumerate(top[:WORDS])}
    classes = {r["class"]: (r["n"], r["words"]) for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    share = np.zeros(SYMBOLS)
    share[0] = ends
    for c, (n, _) in classes.items():
        share[c] = n
    left = {c: [n, words] for c, (n, words) in classes.items()}
    for i, (_, c, n) in enumerate(top[:WORDS]):
        share[1 + i] = n
        share[c] -= n
        left[c][0] -= n
        left[c][1] -= 1
    share = (share + 1) / (share + 1).sum()
    class_total = {c: left.get(c, (0, 0))[0] + SMOOTH * (left.get(c, (0, 0))[1] + 1) for c in range(1 + WORDS, SYMBOLS)}
    tokens, distinct = total["tokens"] + ends, total["distinct"] + (ends > 0)
    base_total = tokens + SMOOTH * (distinct + 1)
    number = np.array([n for _, _, n in top], np.float64)
    symbol = np.array([1 + i if i < WORDS else c for i, (_, c, _) in enumerate(top)], np.int16)
    inside = np.array([0.0 if i < WORDS else np.log10((n + SMOOTH) / class_total[c]) for i, (_, c, n) in enumerate(top)])
    net = train(rows, own, share) if ends else Network.start(share)
    return Model(net, own, {w: i for i, (w, _, _) in enumerate(top)}, symbol, inside, np.log10((number + SMOOTH) / base_total), class_total, ends, tokens, distinct)


PARTIAL = (
    "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "rest array<struct<word: binary, class: int, times: int>>"
)


def partial_scores(rows: DataFrame, model: Model) -> DataFrame:
    """Per row the scores of all symbols and of the table's words; `rest`: the other words, to be looked up."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # of a fixed size: TABLE words and the network
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        symbols, look = Symbols(model.own).__getitem__, model.table.get
        end = float(np.log10((model.ends + SMOOTH) / model.base_total))
        for batch in slices(batches):
            known, base, inside, counts, texts = [], [], [], [], []
            rest_words, rest_times, rest_ends = [], [], [0]
            for text in as_bytes(batch):
                words = text.lower().split()
                at = np.array([look(w, -1) for w in words], np.int64)
                found = at >= 0
                symbol = model.table_symbol[at] if len(model.table) else np.zeros(len(at), np.int16)
                others = [words[i] for i in np.flatnonzero(~found)]
                symbol[~found] = [symbols(w) for w in others]
                hit = at[found]
                texts.append(symbol)
                known.append(len(hit) + (model.ends > 0))
                base.append(float(model.table_base[hit].sum()) + end)
                inside.append(float(model.table_inside[hit].sum()))
                counts.append(len(words) + 1)
                rest = Counter(others)
                rest_words += rest
                rest_times += rest.values()
                rest_ends.append(len(rest_words))
            score = np.add.reduceat(model.net.log10(*windows(texts)), np.cumsum(counts) - counts)
            classes = [symbols(w) for w in rest_words]
            words_left = pa.StructArray.from_arrays(
                [pa.array(rest_words, pa.binary()), pa.array(classes, pa.int32()), pa.array(rest_times, pa.int32())], ["word", "class", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("doc_id"), batch.column("held_out"), pa.array(counts, pa.int64()),
                    pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score + inside, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), words_left),
                ],
                ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"],
            )

    return map_arrow(rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "held_out", "text"), run, PARTIAL)


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
    rows = prepared(docs)
    training = rows.where(~F.col("held_out"))
    counts = settle(count_words(training), "counts")
    model = fit(training, counts)
    found = settle(partial_scores(rows, model), "partial")
    words = found.select("key", F.coalesce("doc_id", F.lit(-1)).alias("id"), F.explode("rest").alias("w")).select("key", "id", "w.*")
    number = F.coalesce("n", F.lit(0))
    totals = F.element_at(F.create_map(*[F.lit(x) for pair in model.class_total.items() for x in pair]), F.col("class"))
    looked_up = words.join(counts.select("word", "n"), "word", "left").select(
        "key",
        "id",
        F.lit(0).alias("copies"),
        (F.col("times") * (number > 0).cast("long")).alias("n_known"),
        (F.col("times") * F.log10((number + SMOOTH) / model.base_total)).alias("base_score"),
        (F.col("times") * F.log10((number + SMOOTH) / totals)).alias("score"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("held_out", "boolean"), ("n_tokens", "long"))],
    )
    own = found.select(
        "key", F.coalesce("doc_id", F.lit(-1)).alias("id"), F.lit(1).alias("copies"), "n_known", "base_score", "score", "doc_id", "held_out", "n_tokens"
    )
    # rows of equal id and text have the same key: their sums are shared out again
    per_key = own.unionByName(looked_up).groupBy("key", "id").agg(
        F.sum("copies").alias("copies"),
        *[F.sum(c).alias(c) for c in ("n_known", "base_score", "score")],
        *[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens")],
    )
    return per_key.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
