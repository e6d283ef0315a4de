"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from daybook.config import Config

# The only spellings a campaign figure may have.
WHOLE_NUMBER = r"^[0-9]+$"
DECIMAL_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
# What counts as a number in a text cell of amounts and points.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _guarded(value: Column, pattern: str, data_type: str, bad_number: str) -> Column:
    text = F.trim(value.cast("string"))
    number = F.when(text.rlike(pattern), text.try_cast(data_type))
    return number if bad_number == "null" else number.otherwise(F.lit(0).cast(data_type))


def guarded_int(value: Column, bad_number: str = "zero", data_type: str = "int") -> Column:
    """Digits only; other spellings are 0 (or null). Digits beyond ``data_type`` are null, which a double never is."""
    return _guarded(value, WHOLE_NUMBER, data_type, bad_number)


def guarded_decimal(value: Column, data_type: str, bad_number: str = "zero") -> Column:
    """Optional minus, digits, optional fraction; other spellings are 0 (or null)."""
    return _guarded(value, DECIMAL_NUMBER, data_type, bad_number)


def _lenient_int(text: Column) -> Column:
    """Text to int as a lenient session compares it: the fraction is cut off, the rest must be digits."""
    return F.regexp_extract(F.trim(text), r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1).try_cast("int")


def _number(value: Column, data_type: T.DataType) -> Column:
    """The number in a cell as a double: no digits are too many or too small. Null for NaN and texts that are none."""
    if isinstance(data_type, T.StringType):
        text = F.trim(value)
        return F.when(text.rlike(NUMBER), text.try_cast("double"))
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def amount(value: Column, data_type: T.DataType, cfg: Config) -> Column:
    """A double, or the type the configuration asks for (beyond its range: null).

    Text such as ``nan`` and the double NaN are null; the literal variant keeps NaN.
    """
    if cfg.literal:
        return value.try_cast("double")
    number = _number(value, data_type)
    return number if cfg.amount_type == "double" else F.when(number.isNotNull(), value.try_cast(cfg.amount_type))


def amount_is_nonzero(value: Column, data_type: T.DataType, cfg: Config) -> Column:
    """Whether there is an amount other than 0, by the value as given."""
    if cfg.literal:
        return (_lenient_int(value) if isinstance(data_type, T.StringType) else value.try_cast("double")) != 0
    return _number(value, data_type) != 0


def points(value: Column, data_type: T.DataType, cfg: Config) -> Column:
    if cfg.literal:
        return _lenient_int(value).cast("double") if isinstance(data_type, T.StringType) else value.try_cast("double")
    return _number(value, data_type)
