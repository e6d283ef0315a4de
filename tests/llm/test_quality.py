"""The classifier on held-out rows of the given tables, and on awkward rows."""

import random

import numpy as np
import pytest

from daybook.llm import quality
from tests.llm import tables

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.judged(quality.scores(docs, quality.fit(docs, labels))).join(labels, "doc_id").where("held_out")
    rows = found.select("quality", "predicted", "score").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.95
    assert np.mean([r["predicted"] for r in rows if r["quality"]]) > 0.98


def test_awkward_rows(spark):
    docs = tables.documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (21, None, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    net = quality.fit(docs, labels)
    found = quality.judged(quality.scores(docs, net))
    assert found.count() == docs.count() and found.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    kept = quality.accept(docs, net)
    assert kept.schema == docs.schema and kept.count() == found.where("predicted = 1").count()
    assert quality.scores(tables.empty(spark), net).count() == 0


@pytest.mark.parametrize("labels, score", [([], 1.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)])
def test_without_two_classes(spark, labels, score):
    docs = tables.documents(spark, n=3)
    net = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r["score"] for r in quality.scores(docs, net).collect()} == {score}


def test_chunks_cover_the_whole_text():
    random.seed(2)
    for n in (0, 1, 255, 256, 257, 448, 449, 5000):
        text = bytes(random.choices(range(1, 256), k=n))
        chunks = quality.cut(text)
        step = quality.CHUNK - quality.OVERLAP
        assert b"".join(c[:step] for c in chunks[:-1]) + chunks[-1] == text
        assert all(len(c) <= quality.CHUNK for c in chunks)


def test_slopes_are_the_gradient():
    random_ = np.random.default_rng(0)
    net = quality.learn([[bytes(random_.integers(1, 9, 256).astype(np.uint8))] * 2 for _ in range(8)], np.array([0.0, 1] * 4), steps=1)
    chunks = random_.integers(0, 9, (6, quality.CHUNK)).astype(np.uint8)
    owner, labels = np.array([0, 0, 1, 2, 2, 2]), np.array([0.0, 1, 1])

    def loss():
        p = quality.logistic(quality.combined(net.pooled(chunks), owner) @ net.weights.astype(float) + net.offset)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slope = quality.slopes(net, chunks, owner, labels)
    for i in (0, 40, 70):
        before, net.weights[i] = loss(), net.weights[i] + 1e-2
        assert (loss() - before) / 1e-2 == pytest.approx(slope["weights"][i], abs=3e-3)
        net.weights[i] -= 1e-2
