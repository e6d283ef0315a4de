"""Small-world graphs: recall against brute force, exact scores, copies, ties."""

import numpy as np
import pytest

from daybook.llm import neighbours
from tests.llm.tables import rows

SCHEMA = "vec_id long, embedding array<float>, rank int, v string, score string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, "x", None) for i, v in data], SCHEMA).repartition(4)


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(np.float32(x)) * float(np.float32(y))
    return total


def usable(data):
    return [(i, v) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]


def brute(data, every=20, k=20):
    taken = usable(data)
    out = []
    for q, a in sorted({(q, tuple(a)) for q, a in taken if q % every == 0}):
        ranked = sorted((-product(a, b), i) for i, b in taken if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return sorted(out, key=str)


def recall(found, exact, k=20):
    """The share of places filled with a score at least that of the true k-th."""
    limit = {}
    for q, _, _, score in exact:
        limit[q] = min(score, limit.get(q, score))
    return sum(score >= limit[q] for q, _, _, score in found) / len(exact)


def clustered(n, width, groups, seed):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, width))
    v = centres[random.integers(0, groups, n)] + random.normal(0, 0.4, (n, width))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


@pytest.mark.parametrize("groups, scale", [(1, 1.0), (40, 1.0), (40, None)])
def test_recall(spark, groups, scale):
    v = clustered(3_000, 24, groups, 5)
    if scale is None:  # lengths differ
        v = v * np.random.default_rng(1).uniform(0.2, 3, (len(v), 1)).astype(np.float32)
    data = [(i, x.tolist()) for i, x in enumerate(v)]
    found, exact = rows(neighbours.neighbours(frame(spark, data), rows=800)), brute(data)
    assert len(found) == len(exact) and recall(found, exact) >= 0.97
    by_id = dict(data)
    assert all(s == product(by_id[q], by_id[i]) and q != i for q, _, i, s in found)
    assert len({(q, i) for q, _, i, _ in found}) == len(found)


def test_few_rows_are_found_in_full(spark):
    data = [(i, v.tolist()) for i, v in enumerate(clustered(300, 8, 5, 2))]
    data += [(1000 + i, [0.5] * 8) for i in range(400)]  # one very common vector
    data += [(40, [0.5] * 8), (40, [0.5] * 8), (41, [0.25] * 8), (41, [0.25] * 8)]  # repeated rows, one id with two vectors
    data += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] + [0.1] * 7), (2060, [float("inf")] * 8), (2080, []),
             (2100, [0.0] * 8), (None, [0.1] * 8), (2200, [-0.0, 1.0] + [0.0] * 6)]
    several = [(i, v) for i, v in data if i != 40] + [(40, [0.5] * 8), (40, [0.5] * 8)]
    assert rows(neighbours.neighbours(frame(spark, several), rows=100_000, beam=800)) == brute(several)
    assert rows(neighbours.neighbours(frame(spark, several), rows=150, beam=800)) == brute(several)
    greatest = rows(neighbours.neighbours(frame(spark, data), rows=150, beam=800).where("query_id = 40"))
    first = max(v for i, v in data if i == 40)
    ranked = sorted((-product(first, b), i) for i, b in usable(data) if i != 40)[:20]
    assert greatest == sorted(((40, n + 1, i, -s) for n, (s, i) in enumerate(ranked)), key=str)


def test_shorter_vectors_count_as_if_zeros_followed(spark):
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5, 4.0]), (2, [1.0]), (20, [0.0, 0.0, 3.0])]
    assert rows(neighbours.neighbours(frame(spark, few))) == brute(few)


def test_small_and_empty_tables(spark):
    for table in ([], [(0, None)], [(0, [1.0])], [(3, [1.0])]):
        assert neighbours.neighbours(frame(spark, table)).count() == 0
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert rows(neighbours.neighbours(frame(spark, few))) == brute(few)


def test_links_of_a_graph_are_flat_and_valid():
    v = clustered(2_000, 16, 10, 8).astype(np.float64)
    graph = neighbours.Graph.build(np.arange(2_000), v)
    assert len(graph.layers) > 1
    for nodes, links in graph.layers:
        assert links.ndim == 2 and links.dtype == np.int32 and set(links.ravel()) <= {-1, *nodes.tolist()}
        assert (links != nodes[:, None]).all()
    again = neighbours.Graph.unpacked(graph.packed().to_pylist()[0])
    q = np.arange(0, 2_000, 20)
    assert all((a == b).all() for a, b in zip(graph.search(q, v[q], 5, 64), again.search(q, v[q], 5, 64), strict=True))
