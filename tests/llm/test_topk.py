"""Exact search against all pairs."""

import numpy as np
import pytest

from daybook.llm import topk
from tests.llm.tables import rows

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in data], SCHEMA).repartition(4)


def brute(data, every=50, k=5):
    usable = [
        (i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64))
        for i, v in data
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % every == 0:
            ranked = sorted(((-int(a @ b), i) for i, b in usable if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def data():
    random = np.random.default_rng(4)
    rows = [(i, random.normal(0, 0.2, 8).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(400)]  # one very common vector
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] + [0.1] * 7), (2150, [float("inf")] * 8), (2200, []), (None, [0.1] * 8)]
    return rows


@pytest.mark.parametrize("block", [10_000, 7])
def test_query_equals_brute_force(spark, data, block):
    assert rows(topk.top_k(frame(spark, data), block=block)) == brute(data)


def test_small_and_empty_tables(spark):
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert rows(topk.top_k(frame(spark, few))) == brute(few)
    for table in ([], [(0, None)], [(0, [1.0])]):
        assert topk.top_k(frame(spark, table)).count() == 0


def test_other_dimensions_take_no_part(spark):
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [1.0]), (3, [0.1, 0.2])]
    assert {r[2] for r in rows(topk.top_k(frame(spark, few)))} == {1, 3}


def test_large_numbers_stay_exact(spark):
    few = [(0, [3e7, 3e7 + 8]), (1, [3e7, -1e7]), (2, [3e7 + 4, 2e7]), (3, [1.0, 1.0])]
    assert rows(topk.top_k(frame(spark, few))) == brute(few)
