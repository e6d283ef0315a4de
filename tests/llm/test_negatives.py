"""Hard negatives against all pairs; boxes against their rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import negatives
from tests.llm.tables import rows

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string, place int"


def frame(spark, data):
    return spark.createDataFrame([(i, v, label, "x", None, 3) for i, v, label in data], SCHEMA).repartition(4)


def mined(spark, data, **settings):
    return rows(negatives.mine(negatives.quantised(frame(spark, data), F.col("label")), **settings))


def brute(data, every=50, positives=5, found=3):
    usable = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, label in data
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    anchors = {}
    for i, label, v in usable:
        if i % every == 0:
            anchors[i] = max(anchors.get(i, (label, v)), (label, v))
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, other, w in usable if i != a)
        for p, i, _ in [x for x in scored if x[2]][:positives]:
            inside = [(s, j) for s, j, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p][:found]
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j) in enumerate(inside)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def data():
    random = np.random.default_rng(9)
    centres = random.normal(size=(6, 8))
    out = [(i, (0.3 * centres[i % 6] + random.normal(0, 0.15, 8)).tolist(), i % 4) for i in range(900)]
    out += [(1000 + i, [0.5] * 8, i % 2) for i in range(400)]  # one very common vector, of two labels
    out += [(3000 + i, (0.1 * random.normal(size=8)).tolist(), 100 + i) for i in range(60)]  # labels of their own
    out += [(2000, None, 1), (2050, [None] * 8, 1), (2100, [float("nan")] + [0.1] * 7, 1), (2150, [float("inf")] * 8, 1),
            (2200, [], 1), (None, [0.1] * 8, 1), (2250, [0.3] * 8, None), (2300, [0.4, 0.5], 2), (2350, [0.0] * 8, 0)]
    return out


@pytest.mark.parametrize("values", [negatives.VALUES, 800])
def test_query_equals_brute_force(spark, data, values):
    assert mined(spark, data, values=values) == brute(data)


def test_repeated_rows_and_ids(spark):
    random = np.random.default_rng(2)
    data = [(i, random.uniform(0, 1, 4).tolist(), i % 2) for i in range(120)]
    assert mined(spark, [*data, (50, [0.9] * 4, 1), (50, [0.9] * 4, 1)]) == brute([*data, (50, [0.9] * 4, 1), (50, [0.9] * 4, 1)])


def test_small_and_empty_tables(spark):
    for table in ([], [(0, None, 1)], [(0, [1.0], None)], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)]):
        assert mined(spark, table) == []
    few = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.7, 0.2], 2), (3, [-1.0, 0.0], 1), (4, [-0.6, 0.0], 2)]
    assert mined(spark, few) == brute(few)


def test_large_numbers_stay_exact(spark):
    few = [(0, [3e5, 3e5 + 8], 1), (1, [3e5, 2e5], 1), (2, [2e5, 2e5], 2), (3, [2e5, 2e5 - 0.25], 2), (4, [2e5, 2e5 + 0.25], 3)]
    assert mined(spark, few) == brute(few)


def test_intervals_hold_every_row():
    random = np.random.default_rng(3)
    v = random.integers(-256, 256, (3_000, 6)).astype(np.float64)
    ids, labels = random.permutation(3_000), random.integers(0, 5, 3_000)
    tree = negatives.Tree(ids, labels, v, leaf=16, fan=4)
    assert sorted(tree.ids) == list(range(3_000)) and len(tree.levels) > 2
    q = random.integers(-256, 256, 6).astype(np.float64)
    above, below = np.maximum(q, 0), np.minimum(q, 0)
    scores, starts = tree.v @ q, np.arange(3_001)
    for level in tree.levels:
        starts = starts[level.starts]  # in rows
        for node in range(len(level.starts) - 1):
            own = slice(starts[node], starts[node + 1])
            assert level.low[node] @ above + level.high[node] @ below <= scores[own].min()
            assert level.high[node] @ above + level.low[node] @ below >= scores[own].max()
            assert (level.label_low[node], level.label_high[node]) == (tree.labels[own].min(), tree.labels[own].max())
            assert level.least[node] == tree.ids[own].min()


def test_boxes_outside_the_window_are_not_opened():
    random = np.random.default_rng(3)
    v = random.integers(0, 256, (20_000, 2)).astype(np.float64)
    tree = negatives.Tree(np.arange(20_000), np.arange(20_000) % 2, v)
    opened = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            opened.append(key)
            return np.asarray(super().__getitem__(key))

    tree.ids = tree.ids.view(Watched)
    found = tree.search(-1, 0, np.array([256.0, 0.0]), [(1_000, 1_500)], 3, True)[0]
    assert len(found) == 3 and all(1_000 <= s <= 1_500 for s, _ in found)
    assert len(opened) < len(tree.levels[0].starts) / 4
