"""Licence scans against every template."""

from collections import Counter

from daybook.llm import license
from tests.llm import tables

MIT = license.TEMPLATES["mit"][3]
TEXTS = [
    "Released under the MIT License.", "prose here\nReleased under the MIT License.\nmore prose", "Licensed under CC BY-NC 4.0", "licensed under cc by 4.0!",
    MIT, "Copyright 2020\n\n" + MIT[:300] + "\n" + MIT[300:] + "\n\nthe end", "All rights reserved.", "rights all reserved", "MIT", "license " * 40,
    "This work is licensed under the GNU General Public License, version 3.\n\n" * 3,
]


def brute(text):
    templates = [(name, Counter(zip(w, w[1:])), len(w) - 1) for name, own in license.TEMPLATES.items() for t in own for w in [license.words(t.encode())]]
    out = []
    for line, lines, found in license.passages((text or "").encode()):
        if (n := len(found) - 1) > 0:
            own = Counter(zip(found, found[1:]))
            best = min((-2 * sum((own & b).values()) / (n + size), name) for name, b, size in templates)
            if -best[0] >= license.THRESHOLD:
                out.append((best[1], -best[0], line, lines))
    return out


def test_scan_equals_all_templates(spark):
    docs = tables.documents(spark, TEXTS)
    found = sorted(((r["doc_id"], [tuple(f) for f in r["found"]]) for r in license.scan(docs).collect()), key=str)
    assert found == sorted(((r["doc_id"], brute(r["text"])) for r in docs.collect()), key=str)
    names = {r["licenses"] for r in license.summary(license.scan(docs)).collect()}
    assert {"mit", "cc-by-nc-4.0", "cc-by-4.0", "all-rights-reserved", "gpl-3.0", ""} <= names
    assert license.summary(license.scan(tables.empty(spark))).count() == 0


def test_every_template_finds_itself(spark):
    rows = [(i, t, name) for i, (name, t) in enumerate((n, t) for n, own in license.TEMPLATES.items() for t in own)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license.summary(license.scan(docs)).collect()}
    assert all(found[i]["license"] == name and found[i]["dice"] == 1.0 for i, _, name in rows)


def test_notices_inside_longer_texts(spark):
    """Of several paragraphs among prose, inside a line, in a text without line ends; and nothing in mere prose."""
    prose = "some words of code and prose that say nothing at all about terms " * 20
    mit = MIT.replace(" The above", "\n\nThe above").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    apache = license.TEMPLATES["apache-2.0"][1].replace(" Unless", "\n\nUnless").replace(" You may", "\n\nYou may")
    bsd = license.TEMPLATES["bsd-3-clause"][3].replace(" 1.", "\n\n1.").replace(" 2.", "\n\n2.").replace(" 3.", "\n\n3.").replace(" THIS", "\n\nTHIS")
    inline = "Copyright 2020 The Authors. Released under the MIT License. See the file LICENSE for details."
    cases = [(f"{prose}\n\n{t}\n\n{prose}", name) for t, name in ((mit, "mit"), (apache, "apache-2.0"), (bsd, "bsd-3-clause"))]
    cases += [(inline, "mit"), (prose + inline + prose, "mit"), (prose, ""), ("x SPDX-License-Identifier: Zlib y", "")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = {r["doc_id"]: (r["licenses"], r["n_passages"]) for r in license.summary(license.scan(docs)).collect()}
    assert found == {i: (name, int(name != "")) for i, (_, name) in enumerate(cases)}
