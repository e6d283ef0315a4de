"""Personal data: base spans against plain patterns, added spans, redaction, and a plan without Python."""

import hashlib
import re

import pytest

from daybook.llm import pii
from tests.llm import tables

KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    total = 0
    for i, figure in enumerate(reversed(digits)):
        double = int(figure) * (1 + i % 2)
        total += double - 9 * (double > 9)
    return total % 10 == 0


def base(text):
    found = [(0, m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m))
    found += [(3, m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in found]


AWKWARD = [
    "a@b.c@d.e x@y.z_q@w.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 00.0.0.000", "é😀 +1 (314) 555-6532 4663622617512349 x",
    "4111 1111 1111 1111 - 5", "4111-1111-1111-1111,4111111111111111", "mail bob (at) ex.com", "%@.@a.b-c..d@e-.f", "+1-2-3 +12345678 +1" + "2" * 20,
    "41111111111111111111111 1 2 3", "x" * 5000 + "@a.b", "1.1.1" * 700, "1" * 5000, "+1-" * 1000 + "234", "x@" + "a." * 3000 + "b",
]


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def test_base_spans(spark):
    docs = tables.documents(spark, AWKWARD)
    found = pii.digests(pii.spans(docs.select("doc_id", "text"))).drop("spans")
    expected = []
    for r in docs.collect():
        spans = base(r["text"] or "")
        numbers = [sum(s[0] == k for s in spans) for k in range(4)]
        expected.append((r["doc_id"], *numbers, hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert tables.rows(found) == sorted(expected, key=str)
    assert pii.digests(pii.spans(tables.empty(spark))).count() == 0


def test_a_phone_of_single_digits(spark):
    text = "+1 (2) - (3) - (4) - (5) - (6) - (7) - (8)"
    assert base(text) == [(3, 0, len(text) - 1)]
    assert [r["n_phone"] for r in pii.digests(pii.spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()] == [1]


@pytest.fixture(scope="module")
def taught(spark):
    """Enough plain cases to learn from, and one whose card and phone run into each other."""
    rows = [(i, f"{('call', 'then')[i % 2]} +1 (314) 555-{6100 + i} or write a{i}@b.org, paid 4111111111111111 from 10.0.0.{i} today") for i in range(120)]
    rows += [(200, "then +1 (314) 555-6532 4111111111111111 was seen"), (201, "nothing 12 34 here"), (202, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_added_spans(spark, taught):
    found = {r["doc_id"]: r for r in pii.digests(pii.spans(taught)).collect()}
    assert found[200]["n_card"] == found[200]["n_phone"] == 0  # the base rules lose both
    assert found[200]["spans"] == "card:23:39,phone:5:22"
    assert found[201]["spans"] == "" == found[202]["spans"]
    for r in taught.where("doc_id < 120").collect():  # base spans stay, and nothing is added to them
        assert found[r["doc_id"]]["spans"] == joined(base(r["text"]))


def test_copies_of_a_table_change_no_spans(spark):
    """Copies are no evidence: nothing unproven passes in a larger table, and what is proven passes in all."""
    rows = [(i, f"call +1 (314) 555-{6100 + i} or write a{i}@b.org, paid 4111111111111111 from 10.0.0.{i} today") for i in range(60)]
    rows += [(60, "call +1 (314) 555-6532 4111111111111111 was seen"), (61, "ask bob (at) ex.com"), (62, "mail: eve [at] ex (dot) org")]
    rows += [(63 + i, f"x{5000 + i}@c.org/") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {i: joined(base(t)) for i, t in rows} | {60: "card:23:39,phone:5:22"}
    for copies in (1, 10, 100):
        found = pii.digests(pii.spans(docs.crossJoin(spark.range(copies).select()))).select("doc_id", "spans")
        assert {tuple(r) for r in found.distinct().collect()} == set(expected.items()), copies
        assert found.count() == copies * len(rows)


def test_redaction(spark, taught):
    rows = {r["doc_id"]: r for r in pii.redact(taught.selectExpr("*", "length(text) AS n_chars", "1 AS spans", "2 AS may")).collect()}
    assert rows[3]["text"] == "then <PHONE> or write <EMAIL>, paid <CARD> from <IP> today" and rows[3]["n_chars"] == len(rows[3]["text"])
    assert rows[200]["text"] == "then <PHONE> <CARD> was seen"
    assert rows[201]["text"] == "nothing 12 34 here" and rows[202]["text"] is None
    assert (rows[3]["spans"], rows[3]["may"]) == (1, 2)
    docs = tables.documents(spark, AWKWARD)
    done = pii.redact(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    assert not any(base(r["text"] or "") for r in done.collect() if len(r["text"] or "") < 200)


def test_no_python_on_the_main_path(taught):
    for frame in (pii.digests(pii.spans(taught)), pii.redact(taught)):
        assert not re.search("Python|Pandas|Arrow|ExternalRDD", frame._jdf.queryExecution().toString())
