"""The base count that is set by hand for single days."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from daybook.config import Config


def base_on(day: Column, cfg: Config) -> Column:
    """The configured value of a day, 0 for every other day."""
    if not cfg.base_overrides:
        return F.lit(0)
    pairs = chain.from_iterable(
        (F.lit(date), F.lit(value).cast("int")) for date, value in sorted(cfg.base_overrides.items())
    )
    return F.coalesce(F.create_map(*pairs)[day], F.lit(0))
