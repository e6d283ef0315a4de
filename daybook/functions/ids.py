"""Card numbers: the join key of every table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from daybook.config import Config

_SUFFIX = ".0"
# Marks the end of a text; a code point that stands for no character, so no text holds it.
_END = "\uffff"


def _without_suffix(text: Column) -> Column:
    """The text without one ``.0`` at its end, and with the end's mark.

    The text stands in the expression once: the optimizer copies expressions into filters and join conditions,
    where each mention is computed again for every row. A regular expression costs several times as much.
    """
    return F.replace(F.concat(text, F.lit(_END)), F.lit(_SUFFIX + _END), F.lit(_END))


def clean_id(value: Column, data_type: T.DataType, cfg: Config) -> Column:
    """Text id without one trailing ``.0`` and without blanks around it; null for a blank cell."""
    text = value.cast("string")
    if cfg.literal:
        return F.trim(F.replace(_without_suffix(text), F.lit(_END)))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        # A whole double prints as 1.2345678E7; go through a decimal to keep all its digits.
        whole = value.try_cast("decimal(38,0)")
        is_whole = whole.cast("double") == value
        text = F.when(is_whole, whole.cast("string")).when(~F.isnan(value), text)
    cleaned = F.trim(_without_suffix(F.trim(text)), F.lit(_END + " "))
    return F.when(~cleaned.isin(*cfg.null_tokens), cleaned)
