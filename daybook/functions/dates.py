"""Dates that arrive as text, and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from daybook.config import Config

# The two accepted beginnings of a deployment date.
ISO_START = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
DAY_FIRST_START = r"^[0-9]{2}-[0-9]{2}-[0-9]{4}"

# Any leap year serves to hold a month and a day without a year.
_LEAP_YEAR = 2000


def to_day(value: Column) -> Column:
    """Date of a date, a timestamp or a text that starts like one; anything else is null."""
    return value.try_cast("date")


def deployment_day(value: Column, data_type: T.DataType, cfg: Config) -> Column:
    """Date written ISO or day first, with or without a time behind it."""
    if not isinstance(data_type, T.StringType):
        return to_day(value)
    iso = value.rlike(ISO_START)
    day_first = value.rlike(DAY_FIRST_START)
    if cfg.literal:
        day_first = day_first & (F.length(value) == 10)
    # Turned into ISO text, so the result does not depend on the session's parser policy.
    turned = F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2))
    return F.when(iso, to_day(F.substring(value, 1, 10))).when(day_first, to_day(turned))


def deployment_day_whole_text(value: Column, data_type: T.DataType, cfg: Config) -> Column:
    """As ``deployment_day``, but the literal variant reads the whole text of an ISO date."""
    if not cfg.literal or not isinstance(data_type, T.StringType):
        return deployment_day(value, data_type, cfg)
    return F.when(value.rlike(ISO_START), to_day(value)).otherwise(deployment_day(value, data_type, cfg))


def month_and_day(value: Column) -> Column:
    """The yearly event of a date, as a date in a fixed leap year."""
    return F.make_date(F.lit(_LEAP_YEAR), F.month(value), F.dayofmonth(value))


def event_in_year(event: Column, year: Column) -> Column:
    """Day of a yearly event in one year; 29 February is kept on the 28th in every year."""
    leap_day = (F.month(event) == 2) & (F.dayofmonth(event) == 29)
    return F.make_date(year, F.month(event), F.when(leap_day, F.lit(28)).otherwise(F.dayofmonth(event)))


def event_in_year_capped(event: Column, year: Column) -> Column:
    """As ``event_in_year``, with any day after the 28th moved to the 28th."""
    return F.make_date(year, F.month(event), F.least(F.dayofmonth(event), F.lit(28)))


def event_gap(day: Column, event: Column, year_shift: int = 0) -> Column:
    """Signed days from the event in the day's own year (or a neighbouring one) to the day."""
    return F.datediff(day, event_in_year(event, F.year(day) + year_shift))


def near_event(day: Column, event: Column, cfg: Config) -> Column:
    """True when the day lies within the event window, both ends included."""
    shifts = (-1, 0, 1) if cfg.wrap_year_end else (0,)
    near = F.lit(False)
    for shift in shifts:
        near = near | event_gap(day, event, shift).between(-cfg.event_window_days, cfg.event_window_days)
    return near


def first_after(day: Column, months: int) -> Column:
    """First day ``d`` for which ``add_months(d, -months) > day``.

    ``add_months`` cuts to the end of a short month, so where the shifted day was cut, the month
    it was cut from has no such day and the first match is the next month's first.
    """
    following = F.date_add(day, 1)
    shifted = F.add_months(following, months)
    return F.when(F.dayofmonth(shifted) == F.dayofmonth(following), shifted).otherwise(F.date_add(shifted, 1))


def month_key(day: Column, cfg: Config) -> Column:
    """Orders months. The literal variant is unpadded text, which puts 2021-10 before 2021-4."""
    if cfg.literal:
        return F.concat(F.year(day).cast("string"), F.lit("-"), F.month(day).cast("string"))
    return F.trunc(day, "month")


def first_event_from(event: str, start: str) -> str:
    """SQL: the first day on or after ``start`` on which a yearly event (see ``month_and_day``) falls; 29 February falls in
    leap years only, which are at most eight years apart."""
    year, month, day = f"year({start})", f"month({event})", f"day({event})"
    leap = "y % 4 = 0 AND (y % 100 <> 0 OR y % 400 = 0)"
    this = f"make_date({year}, {month}, {day})"
    leap_days = f"transform(filter(sequence({year}, {year} + 8), y -> {leap}), y -> make_date(y, 2, 29))"
    return (
        f"CASE WHEN {month} = 2 AND {day} = 29 THEN array_min(filter({leap_days}, d -> d >= {start})) "
        f"WHEN {this} >= {start} THEN {this} ELSE make_date({year} + 1, {month}, {day}) END"
    )
