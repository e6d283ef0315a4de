"""Column names of raw exports. Works on names only, never on rows."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F


# What a column name may consist of, what stands for two other characters, and the name of
# a blank header.
ALLOWED = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")
SPELLED = {" ": "_", "%": "pct"}
UNNAMED = "unnamed"


def column_name(header: object) -> str:
    """The header in lower case, character by character: spelled out, kept or dropped."""
    if header is None or isinstance(header, float) and math.isnan(header):
        return UNNAMED
    spelled = [SPELLED.get(character, character) for character in str(header).lower().strip()]
    return "".join(part for part in spelled if ALLOWED.issuperset(part)) or UNNAMED


def clean_headers(raw: Iterable[object], first_column: str | None = None) -> list[str]:
    """Lower-case, unique column names; the n-th repeat of a name gets the suffix ``_n``.

    A suffixed name that is itself taken is suffixed again, so the result never holds a duplicate.
    """
    names = list(raw)
    if first_column is not None and names:
        names[0] = first_column
    taken: set[str] = set()
    repeats: Counter[str] = Counter()
    cleaned = []
    for base in map(column_name, names):
        name = base
        while name in taken:
            repeats[base] += 1
            name = f"{base}_{repeats[base]}"
        taken.add(name)
        cleaned.append(name)
    return cleaned


def standardise_headers(df: DataFrame, first_column: str | None = None) -> DataFrame:
    return df.toDF(*clean_headers(df.columns, first_column))


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay null instead of turning into words."""
    return df.select([F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])
