"""Near-duplicates against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from daybook.llm import simhash
from daybook.llm.components import components
from tests.llm import tables


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """The component (its members' set) of each fingerprint."""
    whole = {p: {p} for p in prints}
    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 3 and whole[a] is not whole[b]:
                union = whole[a] | whole[b]
                for p in union:
                    whole[p] = union
    return whole


def test_query_equals_all_pairs(spark):
    docs = tables.documents(spark)
    data = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    whole = brute_components({p for _, p in data})
    expected = []
    for doc_id, p in data:
        ids = [i for i, q in data if q in whole[p] and i is not None]
        expected.append((doc_id, f"{p:016x}", min(ids, default=None)))
    assert tables.rows(simhash.component_ids(docs)) == sorted(expected, key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({frozenset(x) for x in whole.values()})
    assert simhash.component_ids(tables.empty(spark)).count() == 0
    assert simhash.keep_one(tables.empty(spark)).count() == 0


def test_links_connect_chains_and_dense_groups(spark):
    """Chains of single steps, a dense ball, and strangers: the same components as all pairs give."""
    random = np.random.default_rng(5)
    prints = {0, (1 << 64) - 1, 1 << 63}
    centre = int(random.integers(1 << 62))
    for _ in range(400):
        flipped = centre
        for bit in random.integers(0, 12, 4):
            flipped ^= 1 << int(bit)
        prints.add(flipped)
    step = int(random.integers(1 << 62))
    for bit in range(0, 60, 3):
        step ^= 0b111 << bit
        prints.add(step)
    prints |= {int(x) for x in random.integers(0, 1 << 63, 200)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fingerprint long")
    found = {r["node"]: r["root"] for r in components(simhash.links(frame)).collect()}
    whole = brute_components(prints)
    groups = {}
    for (s,), p in zip(signed, prints, strict=True):
        groups.setdefault(found.get(s, s), set()).add(p)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in whole.values()}


@pytest.mark.parametrize("n", [1, 2, 50])
def test_spanning_reaches_every_member_once(n):
    members = np.arange(n, dtype=np.uint64)
    left, right = simhash.spanning(members, 64)
    assert sum(map(len, right)) == n - 1
