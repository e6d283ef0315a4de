"""The filter audit against a plain loop over all orders, and its retractions."""

import re
from collections import Counter
from itertools import permutations

import pytest

from daybook.llm import interaction
from tests.llm.tables import documents, empty, rows

LABELS = "doc_id long, quality int, toxic int, part string"


def labels(spark):
    """Also repeated, contradicting, null and unknown ones."""
    return spark.createDataFrame(
        [(0, 1, 0, "x"), (1, 0, 1, "x"), (3, 1, 1, None), (3, 0, 0, "x"), (40, 1, None, "x"), (48, None, 1, "x"), (9999, 1, 1, "x"), (None, 1, 1, "x")],
        LABELS,
    )


def brute(docs, marks):
    good = {r[0] for r in marks if r[0] is not None and r[1] == 1}
    toxic = {r[0] for r in marks if r[0] is not None and r[2] == 1}
    texts = [(r["doc_id"], r["source"] or "", r["text"] or "") for r in docs]
    smallest = {}
    for i, _, text in texts:
        if i is not None:
            smallest[text] = min(i, smallest.get(text, i))
    counts = Counter()
    for i, part, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > smallest[text],
        }
        failed = frozenset(c for c in fails if fails[c])
        for order in permutations("ABCDE"):
            gone = False
            for step, c in enumerate(order, 1):
                at = (part, "".join(order), step)
                removed = c in failed and not gone
                counts[at, "kept"] += not gone and c not in failed
                counts[at, "removed"] += removed
                counts[at, "redundant"] += c in failed and gone
                counts[at, "unique_fails"] += failed == {c}
                counts[at, "good_lost"] += removed and i in good
                counts[at, "toxic_lost"] += removed and i in toxic
                counts[part, c] += removed
                gone |= c in failed
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    parts = {part for _, part, _ in texts}
    return sorted(
        (
            (part, "".join(order), step, *[counts[(part, "".join(order), step), name] for name in names], counts[part, c])
            for part in parts for order in permutations("ABCDE") for step, c in enumerate(order, 1)
        ),
        key=str,
    )


EXTRA = [
    "SHOUT " * 210, "a$b " * 250, "same words " * 150, "x" * 100, "A", "#", "tab\tand\x0bother\x1cbreaks", "tab\tand\x0bother\x1cbreaks",
    " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(300)),
    "".join(f"Very Long {i} " for i in range(60_000)),
]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Files whose ids fall, so that nearly every later file takes texts from earlier ones."""
    folder = f"{tmp_path_factory.mktemp('audit')}/documents.parquet"
    docs = documents(spark, EXTRA).selectExpr(
        "doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE 'part two' END AS source",
        "fingerprint AS key", "base AS mask", "score AS n", "n_chars AS part",
    )
    docs = docs.union(docs.where("text IS NOT NULL").selectExpr("doc_id + 500", "text", "'copies'", "key", "mask", "n", "part"))
    table = docs.collect()
    for low, high in ((500, 9999), (40, 500), (3, 40), (None, 3)):
        part = docs.where("doc_id < 3 OR doc_id IS NULL" if low is None else f"doc_id >= {low} AND doc_id < {high}")
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder, table


@pytest.mark.parametrize("batches", [1, 4])
def test_report_equals_brute_force(spark, corpus, batches):
    folder, table = corpus
    marks = labels(spark)
    assert rows(interaction.audit(spark, folder, marks, batches=batches)) == brute(table, marks.collect())


def test_a_smaller_id_retracts_the_earlier_mask(spark):
    state = interaction.Audit(spark, spark.createDataFrame([], LABELS))
    row = "doc_id long, text string, source string"
    state.add(spark.createDataFrame([(9, "t", "a"), (9, "t", "b"), (11, "t", "a")], row), 0)
    assert rows(state.counters()) == [("a", 1, False, False, 1), ("a", 17, False, False, 1), ("b", 1, False, False, 1)]
    state.add(spark.createDataFrame([(5, "t", "c"), (12, "t", "b")], row), 1)
    after = [("a", 17, False, False, 2), ("b", 17, False, False, 2), ("c", 1, False, False, 1)]
    assert rows(state.counters()) == after
    state.add(spark.createDataFrame([(5, "t", "c"), (12, "t", "b")], row), 1)  # run again after a failure
    assert rows(state.counters()) == after
    state.add(spark.createDataFrame([(5, "t", "c"), (7, "t", "a")], row), 2)  # the holder's id once more
    assert rows(state.counters()) == [("a", 17, False, False, 3), ("b", 17, False, False, 2), ("c", 1, False, False, 2)]


def test_a_common_text_is_combined_before_it_is_shuffled(spark):
    """What one text has in the state and in a batch does not grow with its copies."""
    state = interaction.Audit(spark, spark.createDataFrame([], LABELS))
    for batch, start in enumerate((10_000, 0)):
        state.add(spark.range(start, start + 5_000).selectExpr("id AS doc_id", "'copy' AS text", "'p' AS source"), batch)
    assert state.table("changes", interaction.CHANGES).count() == 3
    assert rows(state.counters()) == [("p", 1, False, False, 1), ("p", 17, False, False, 9_999)]


def test_empty_tables(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    empty(spark).write.parquet(path)
    assert interaction.audit(spark, path, spark.createDataFrame([], LABELS)).count() == 0
