"""Hit words against a scan of all windows."""

import hashlib
import re
import tracemalloc

import pytest

from daybook.llm import decontaminate
from tests.llm import tables


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    found, hit, ids = words(text), set(), set()
    for item_id, item in items:
        own = words(item)
        for k in range(max(1, len(own) - 12) if own else 0):
            window = own[k : k + 13]
            for i in range(len(found) - len(window) + 1):
                if found[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    ids.add(item_id)
    listed = ",".join(sorted(str(i) for i in ids if i is not None))
    verdict = len(hit) > 0 and 20 * len(hit) >= len(found)
    return len(found), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), verdict


@pytest.fixture(scope="module")
def data(spark):
    passage = " ".join(f"w{i % 17}" for i in range(40))
    items = [
        (1, passage), (10, "Short item, of FIVE words"), (2, None), (3, " .. "), (None, "x y z nothing"), (10, "one two"), (7, "solo"),
        (8, " ".join(f"q{i}" for i in range(13))), (9, " ".join(f"q{i}" for i in range(5, 30))), (1, passage),
    ]
    extra = [
        passage, "before " + passage.upper() + " after " + passage, "short item of five words", "solo solo, SOLO", "one", "two one two",
        "x-y-z nothing", " ".join(f"q{i}" for i in range(29)), " ".join(f"q{i}" for i in range(12)), "long " * 500 + "solo", "wörter solo ß",
    ]
    return tables.documents(spark, extra), spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block_words", [10**6, 20])
def test_query_equals_brute_force(spark, data, block_words):
    docs, benchmark, items = data
    expected = sorted(((r["doc_id"], *brute(r["text"], items)) for r in docs.collect()), key=str)
    assert tables.rows(decontaminate.judged(decontaminate.hits(docs, benchmark, block_words=block_words))) == expected


def test_removal_keeps_columns_and_clean_rows(spark, data):
    docs, benchmark, items = data
    kept = decontaminate.remove(docs, benchmark)
    assert kept.schema == docs.schema
    assert tables.rows(kept) == tables.rows(spark.createDataFrame([r for r in docs.collect() if not brute(r["text"], items)[-1]], docs.schema))


def test_empty_tables(spark, data):
    docs, benchmark, _ = data
    assert decontaminate.hits(tables.empty(spark), benchmark).count() == 0
    assert decontaminate.remove(docs, benchmark.limit(0)).count() == docs.count()


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "z c d e f g h"), (3, "c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "x c d e f g y"), (6, "nothing")], "item_id long, text string")
    assert tables.rows(decontaminate.longest_matches(docs, items)) == [("5", 5, 1, 2, 1)]


def test_repeated_words_and_rows_take_little(spark):
    """One word a million times, against items of that word alone that are repeated many times."""
    text, item = b"same " * 1_000_000, b"same " * 300
    path = decontaminate.written(spark.createDataFrame([(i % 3, item.decode()) for i in range(300)], "item_id long, text string"))
    detector = decontaminate.Detector(path, 13, decontaminate.BLOCK_WORDS)
    tracemalloc.start()
    n_words, n_hit, items = detector([text, b"same " * 12, b"", b"other"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n_words, n_hit, items) == ([1_000_000, 12, 0, 1], [1_000_000, 0, 0, 0], [{0, 1, 2}, set(), set(), set()])
    assert peak < 600 << 20


def test_pairs_are_joined_in_parts(spark, data, monkeypatch):
    """The same result when only a few pairs fit at a time."""
    docs, benchmark, items = data
    path = decontaminate.written(benchmark)
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    whole = decontaminate.Detector(path, 13, 10**6)(texts)
    monkeypatch.setattr(decontaminate, "PAIRS", 2)
    assert decontaminate.Detector(path, 13, 10**6)(texts) == whole


def test_benchmark_does_not_pass_through_the_driver(spark, data, monkeypatch):
    docs, benchmark, _ = data
    for name in ("collect", "toLocalIterator", "toPandas"):
        monkeypatch.setattr(type(benchmark), name, lambda *_: pytest.fail("through the driver"))
    decontaminate.hits(docs, benchmark)
