"""Language-model scores: exact counts and base scores, normalised probabilities, a gain on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from daybook.llm import lm
from tests.llm import tables

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def check(frame, docs):
    """Everything of the contract but the score."""
    held = [r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in docs]
    counts = Counter(t for r, h in zip(docs, held, strict=True) if not h for t in tokens(r["text"]))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            (r["doc_id"], h, len(own), sum(counts[t] > 0 for t in own), n, round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own), 6))
            for r, h in zip(docs, held, strict=True)
            for own in [tokens(r["text"])]
        ),
        key=str,
    )
    found = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in frame), key=str)
    assert found == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in frame)


@pytest.mark.parametrize("table", [lm.TABLE, 200])
def test_given_tables(spark, monkeypatch, table):
    """Also with a table so small that most words are looked up by the join."""
    monkeypatch.setattr(lm, "TABLE", table)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    frame = lm.scores(docs).collect()
    check(frame, docs.collect())
    held = [r for r in frame if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_awkward_rows(spark):
    docs = tables.documents(spark)
    check(lm.scores(docs).collect(), docs.collect())
    assert lm.scores(tables.empty(spark)).count() == 0


def test_symbol_probabilities_sum_to_one():
    net = lm.Network.start(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS))
    contexts = np.repeat(np.array([[1, 2, 3, 4]]), lm.SYMBOLS, 0)
    assert (10.0 ** net.log10(contexts, np.arange(lm.SYMBOLS))).sum() == pytest.approx(1, abs=1e-5)


def test_all_words_of_a_model_sum_to_one(spark):
    """Own words, table words and looked-up words of every class, and an unseen one, share out all probability."""
    rows = lm.prepared(spark.read.parquet(f"{SF_DIR}/documents.parquet")).where("NOT held_out")
    counts = lm.count_words(rows)
    model = lm.fit(rows, counts)
    own = set(model.own)
    inside = Counter()
    for r in counts.collect():
        if bytes(r["word"]) not in own:
            inside[r["class"]] += (r["n"] + lm.SMOOTH) / model.class_total[r["class"]]
    for c, total in model.class_total.items():
        assert inside[c] + lm.SMOOTH / total == pytest.approx(1)
