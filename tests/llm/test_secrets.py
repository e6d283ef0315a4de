"""Secrets: spans against plain patterns, and what the ledger scans again."""

import hashlib
import re

from daybook.llm import secrets
from daybook.llm.common import scratch
from tests.llm import tables


def any_case(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = "(" + "|".join(map(any_case, ["password", "passwd", "secret", "token"])) + "|" + any_case("api") + "_?" + any_case("key") + ")"
ASSIGN += r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


AWKWARD = [
    'password="abc" PASSWORD = \'abcdef\' Api_Key:xx12345', "secret=token:abcdef token=password=x", "paſſword=abcdef toKen=abcdef",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 20, "é😀 " + "0a" * 12 + " " + "f" * 23 + "g" + "1" * 40, "apikey : 'a.b-c=d/e+f'",
    "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----", "postgres://me:pass@host/db",
]


def test_query_equals_plain_patterns(spark):
    docs = tables.documents(spark, AWKWARD)
    found = secrets.digests(secrets.scanned(spark, docs))
    expected = []
    for r in docs.collect():
        spans = base(r["text"] or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()
        expected.append((r["doc_id"], *[sum(s[2] == k for s in spans) for k in secrets.BASE], digest))
    assert tables.rows(found.drop("spans")) == sorted(expected, key=str)
    kinds = {s.split(":")[0] for r in found.collect() for s in r["spans"].split(",")}
    assert {"code_host", "private_key", "address"} <= kinds
    assert secrets.digests(secrets.scanned(spark, tables.empty(spark))).count() == 0


def test_only_unseen_pairs_are_scanned(spark, monkeypatch):
    folder = f"{scratch(spark, 'ledger')}/blobs"

    def versions(*rows):
        return spark.createDataFrame(list(rows), "path string, version int, text string, spans string, blob int")

    first = versions(("a", 1, "token=abcdefg", "x", 1), ("b", 1, "token=abcdefg", "x", 1), ("c", 1, None, None, None))
    assert secrets.update(first, folder).count() == 2  # one blob of two paths, and the empty one
    second = versions(("a", 2, "token=abcdefg!", "x", 1), ("b", 1, "token=abcdefg", "x", 1))
    assert secrets.update(second, folder).count() == 3
    assert secrets.update(second, folder).count() == 3
    found = secrets.findings(first.union(second), folder)
    assert found.columns == ["path", "version", "spans", "blob", "spans_"]
    assert found.count() == 5 and found.where("size(spans_) = 1").count() == 4
    monkeypatch.setattr(secrets, "rule_version", lambda: "next")
    assert secrets.update(second, folder).count() == 5  # new rules see every blob again
