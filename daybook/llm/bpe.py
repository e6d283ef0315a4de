"""Byte-pair encoding and decoding in numpy, many words at a time.

The vocabulary file is one of the `tokenizers` library (BPE with word ends, byte-level alphabet). Its
normaliser and pre-tokenizer cut a text into words as the library does; the merges are ours: the symbols
of many words lie in one flat array, the pairs of neighbours are looked up by binary search in the sorted
pair keys, and every round merges in each word all places of its lowest-ranked pair, from the left.

A text is cut at ASCII white space first. No word, special token or composed character reaches across
it, so a piece has the same ids wherever it stands and is encoded once per task while it is kept.

Null and empty texts have no ids and decode to the empty text. Rows are kept as they are, repeated or
not; a null doc_id stays null.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import as_bytes, id_and_text, map_arrow, slices

#: Pieces that a task keeps with their ids.
KEPT_PIECES = 300_000
NONE = np.iinfo(np.int64).max
#: Below U+0300 normal form C changes nothing, and letters, numbers and lower case are the same in every
#: version of Unicode; other pieces go through the library's normaliser and pre-tokenizer.
BEYOND_LATIN = re.compile("[\u0300-\U0010ffff]")
LATIN_WORDS = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Bpe:
    """One vocabulary: `encode` gives the ids of UTF-8 texts as packed little-endian uint32, `decode` the text."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, library = spec["model"], Tokenizer.from_file(path)
        self.normalizer, self.splitter, self.kept = library.normalizer, library.pre_tokenizer, kept
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {t.encode(): i for t, i in special.items()}
        self.special_split = re.compile(b"(" + b"|".join(re.escape(t) for t in self.special) + b")") if special else None
        self.size = 1 + max([*vocab.values(), *special.values()])
        alphabet = byte_alphabet()
        self.inner = np.array([vocab.get(c, -1) for c in alphabet], np.int64)
        self.last = np.array([vocab.get(c + end, -1) for c in alphabet], np.int64)
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.products = np.array([vocab[a + b] for a, b in pairs], np.int64)
        tokens = [b""] * self.size
        for t, i in {**vocab, **special}.items():
            tokens[i] = t.encode()
        self.tokens = tokens
        self.pieces: dict[bytes, bytes] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word's begin (one more: the end)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols, word = self.inner[flat], np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.last[flat[ends]]
        done_symbols, done_word = [], []
        while symbols.size:
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            known = (self.keys[at] == pair) & (word[1:] == word[:-1])
            rank = np.r_[np.where(known, self.ranks[at], NONE), NONE]
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
            ended = lowest == NONE
            done_symbols.append(symbols[ended])
            done_word.append(word[ended])
            chosen = np.flatnonzero((rank == lowest) & ~ended)
            # of a row of overlapping places (as in "aaa") the first, third, ... are merged
            first = np.r_[True, np.diff(chosen) != 1][: len(chosen)]
            run = np.maximum.accumulate(np.where(first, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
            symbols[chosen] = self.products[rank[chosen]]
            stay = ~ended
            stay[chosen + 1] = False
            symbols, word = symbols[stay], word[stay]
        symbols, word = np.concatenate([symbols, *done_symbols]), np.concatenate([word, *done_word])
        symbols = symbols[np.argsort(word, kind="stable")]
        return symbols, np.r_[0, np.cumsum(np.bincount(word, minlength=len(words)))]

    def rare_words(self, text: str) -> list[str]:
        """The words of a text, by the library's own normaliser and pre-tokenizer."""
        found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in w).decode("utf-8", "replace") for w, _ in found]

    def cut_words(self, texts: list[str], place: dict[str, int]) -> list[list[int]]:
        """The words of each text as their numbers in `place`, which takes up new words."""
        cut: list[list[int]] = [[] for _ in texts]
        plain = [i for i, t in enumerate(texts) if not BEYOND_LATIN.search(t)]
        rows = iter(plain)
        own: list[int] = []
        # one search for all of them; a line end parts the texts, which have none
        for word in LATIN_WORDS.findall("\n" + "\n".join([texts[i] for i in plain]).lower()) if plain else ():
            if word == "\n":
                own = cut[next(rows)]
            else:
                own.append(place.setdefault(word, len(place)))
        if len(plain) < len(texts):
            for i in set(range(len(texts))).difference(plain):
                cut[i] = [place.setdefault(w, len(place)) for w in self.rare_words(texts[i])]
        return cut

    def learn(self, pieces: list[bytes]) -> None:
        """Encodes pieces that are not kept yet, all of them in the same rounds."""
        place: dict[str, int] = {}
        marked = [p for p in pieces if b"<|" in p and self.special_split and self.special_split.search(p)]
        plain = list(set(pieces).difference(marked)) if marked else pieces
        parts = self.cut_words([p.decode("utf-8", "replace") for p in plain], place)
        marked_parts = []
        for piece in marked:
            own: list[int] = []
            for part in self.special_split.split(piece):
                if part in self.special:
                    own.append(-self.special[part] - 1)
                elif part:
                    own += self.cut_words([part.decode("utf-8", "replace")], place)[0]
            marked_parts.append(own)
        symbols, starts = self.merge([w.encode() for w in place])
        if (symbols < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        packed, starts = symbols.astype("<u4").tobytes(), (4 * starts).tolist()
        ids = [packed[a:b] for a, b in zip(starts, starts[1:])]
        for piece, own in zip(plain, parts, strict=True):
            self.pieces[piece] = ids[own[0]] if len(own) == 1 else b"".join([ids[w] for w in own])
        for piece, own in zip(marked, marked_parts, strict=True):
            self.pieces[piece] = b"".join([ids[w] if w >= 0 else (-w - 1).to_bytes(4, "little") for w in own])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.pieces) > self.kept:
            self.pieces.clear()
        cut = [t.split() for t in texts]
        new = {p for pieces in cut for p in pieces if p not in self.pieces}
        if new:
            self.learn(list(new))
        kept = self.pieces
        return [b"".join([kept[p] for p in pieces]) for pieces in cut]

    def decode(self, ids: bytes) -> str:
        """The tokens joined by a blank, as the library does for a vocabulary without a decoder."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode()


@cache
def bpe(path: str) -> Bpe:
    """One per Python worker."""
    return Bpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, token_ids (binary: packed little-endian uint32) and decoded (text) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for batch in slices(batches):
            ids = coder.encode(as_bytes(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())],
                ["doc_id", "token_ids", "decoded"],
            )

    return map_arrow(id_and_text(docs), run, "doc_id long, token_ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """The contract's columns of what `encode_decode` gives."""
    return encoded.select(
        "doc_id",
        F.floor(F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
