"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, fingerprint int, base string"


def documents(spark, extra=(), seed=3, n=40):
    """Prose, copies, near copies, repeated rows, nulls, empties, a very long text, and columns whose names clash."""
    random.seed(seed)
    vocabulary = ["".join(random.choice("abcdehilnorstü") for _ in range(random.randint(2, 8))) for _ in range(300)]
    texts = [" ".join(random.choices(vocabulary, k=random.randint(20, 120))) for _ in range(n)]
    texts += [texts[0], texts[1].upper(), texts[2] + " one more", None, "", "  \n\t ", "a", "one two", None]
    texts.append(" ".join(random.choices(vocabulary, k=30_000)))
    rows = [(i, t) for i, t in enumerate([*texts, *extra])]
    rows += [rows[3], rows[3], (3, "another text of the same id"), (None, texts[5]), (None, None), (None, texts[5])]
    full = [(i, t, None, "src", None if t is None else len(t), "x", 1, None) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)
