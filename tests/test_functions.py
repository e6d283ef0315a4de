"""Cleaning and calendar functions, cell by cell, under ANSI mode."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F, types as T

from daybook.functions import dates, ids, numbers
from daybook.functions.headers import as_text, clean_headers, standardise_headers
from tests.small import CONFIG

LITERAL = replace(CONFIG, semantics="reference")
TEXT = T.StringType()


def each(spark, function, values, data_type="string"):
    """The function on each value, in order."""
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {data_type}")
    return [row[1] for row in frame.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_headers():
    raw = ["Sale Value", "Sale Value", None, "Conversion %", " ATS ", "a", "a", "a_1", None]
    assert clean_headers(raw) == [
        "sale_value", "sale_value_1", "unnamed", "conversion_pct", "ats", "a", "a_1", "a_1_1", "unnamed_1",
    ]
    assert clean_headers([float("nan"), "Month (Year)"], first_column="MonthYear") == ["monthyear", "month_year"]
    assert clean_headers(["a_1", "a", "a"]) == ["a_1", "a", "a_2"]
    assert clean_headers(["##", ""]) == ["unnamed", "unnamed_1"]
    assert clean_headers([]) == []


def test_headers_on_a_frame_with_duplicate_names(spark):
    frame = spark.createDataFrame([(1, 2.5, None)], "a int, b double, c string").toDF("A b", "A b", "a.b")
    clean = as_text(standardise_headers(frame))
    assert clean.dtypes == [("a_b", "string"), ("a_b_1", "string"), ("ab", "string")]
    assert clean.collect()[0] == ("1", "2.5", None)


def test_ids(spark):
    values = ["123.0", " 123.0", "123.00", "10.05", "", "None", "nan", "NaT", "123.0 ", " ", ".0", None]
    cleaned = each(spark, lambda v: ids.clean_id(v, TEXT, CONFIG), values)
    assert cleaned == ["123", "123", "123.00", "10.05", None, None, None, None, "123", None, None, None]
    literal = each(spark, lambda v: ids.clean_id(v, TEXT, LITERAL), values)
    assert literal == ["123", "123", "123.00", "10.05", "", "None", "nan", "NaT", "123.0", "", "", None]


def test_ids_of_number_columns(spark):
    values = [12345678.0, 1.5, float("nan"), None, 1234567890123456.0]
    cleaned = each(spark, lambda v: ids.clean_id(v, T.DoubleType(), CONFIG), values, "double")
    assert cleaned == ["12345678", "1.5", None, None, "1234567890123456"]
    assert each(spark, lambda v: ids.clean_id(v, T.LongType(), CONFIG), [7, None], "long") == ["7", None]


def test_plain_dates(spark):
    values = ["2024-02-01", "2024-02-01 10:00:00", "2024-02-01T10:00:00", "2024-13-01", "None", None]
    day = dt.date(2024, 2, 1)
    assert each(spark, dates.to_day, values) == [day, day, day, None, None, None]
    assert each(spark, dates.to_day, [dt.datetime(2024, 2, 1, 23, 59)], "timestamp_ntz") == [day]


def test_deployment_dates(spark):
    values = [
        "2024-02-01xyz", "2024-02-01 09:30:00", "01-02-2024", "01-02-2024 10:00:00", "31-02-2024", "99-99-2024",
        "2024/02/01", "2024-02-30", "", None,
    ]
    day = dt.date(2024, 2, 1)
    corrected = [day, day, day, day, None, None, None, None, None, None]
    assert each(spark, lambda v: dates.deployment_day(v, TEXT, CONFIG), values) == corrected
    assert each(spark, lambda v: dates.deployment_day_whole_text(v, TEXT, CONFIG), values) == corrected
    literal = [day, day, day, None, None, None, None, None, None, None]
    assert each(spark, lambda v: dates.deployment_day(v, TEXT, LITERAL), values) == literal
    whole = [None, day, day, None, None, None, None, None, None, None]
    assert each(spark, lambda v: dates.deployment_day_whole_text(v, TEXT, LITERAL), values) == whole
    assert each(spark, lambda v: dates.deployment_day(v, T.DateType(), CONFIG), [day], "date") == [day]


def test_guarded_numbers(spark):
    values = ["100", " 50 ", "1,200", "12.0", "-3", "", None, "99999999999"]
    assert each(spark, numbers.guarded_int, values) == [100, 50, 0, 0, 0, 0, 0, None]
    assert each(spark, lambda v: numbers.guarded_int(v, "null"), values) == [100, 50] + [None] * 6
    values = ["-2.5", "12%", "1e3", ".5", None, "7"]
    assert each(spark, lambda v: numbers.guarded_decimal(v, "double"), values) == [-2.5, 0.0, 0.0, 0.0, 0.0, 7.0]
    assert each(spark, numbers.guarded_int, [5, None], "int") == [5, 0]


def test_amounts_and_points(spark):
    values = ["0.5", "0", "0.0", "nan", "None", " 12 ", "50.75", "49.9", None]

    def nonzero(cfg):
        return each(spark, lambda v: F.coalesce(numbers.amount_is_nonzero(v, TEXT, cfg), F.lit(False)), values)

    assert nonzero(CONFIG) == [True, False, False, False, False, True, True, True, False]
    # A lenient session compares the whole part only.
    assert nonzero(LITERAL) == [False, False, False, False, False, True, True, True, False]
    points = [None if p is None else float(p) for p in each(spark, lambda v: numbers.points(v, TEXT, CONFIG), values)]
    assert points == [0.5, 0, 0, None, None, 12, 50.75, 49.9, None]
    points = [None if p is None else float(p) for p in each(spark, lambda v: numbers.points(v, TEXT, LITERAL), values)]
    assert points == [0, 0, 0, None, None, 12, 50, 49, None]
    doubles = each(spark, lambda v: numbers.amount(v, T.DoubleType(), CONFIG), [float("nan"), 1.25, None], "double")
    assert doubles == [None, 1.25, None]


def test_no_number_is_too_long(spark):
    """16, 21 and 30 digits, 5 and 9 decimals: none is lost, cut or rounded away."""
    values = ["123456789012345.5", "123456789012345678901", "1" + "0" * 29, "0.00001", "0.123456789"]
    exact = [float(v) for v in values]
    assert each(spark, lambda v: numbers.amount(v, TEXT, CONFIG), values) == exact
    assert each(spark, lambda v: numbers.points(v, TEXT, CONFIG), values) == exact
    assert each(spark, lambda v: numbers.amount_is_nonzero(v, TEXT, CONFIG), values) == [True] * 5
    assert each(spark, lambda v: numbers.guarded_decimal(v, CONFIG.figure_type), values) == exact
    assert each(spark, lambda v: numbers.guarded_int(v, data_type="double"), values[1:3]) == exact[1:3]
    assert each(spark, lambda v: numbers.points(v, TEXT, CONFIG) > 50, ["50.000001", "50"]) == [True, False]


def test_a_type_of_the_caller_adds_up_exactly(spark):
    cfg = replace(CONFIG, amount_type="decimal(18,4)")
    assert [float(v) for v in each(spark, lambda v: numbers.amount(v, TEXT, cfg), ["1.25", "0.3"])] == [1.25, 0.3]


def test_ids_with_a_blank_before_the_suffix(spark):
    values = ["123 .0", "123.0 ", " 123", ".0", "None.0"]
    assert each(spark, lambda v: ids.clean_id(v, TEXT, CONFIG), values) == ["123", "123", "123", None, None]
    assert each(spark, lambda v: ids.clean_id(v, TEXT, LITERAL), values) == ["123", "123.0", "123", "", "None"]


def test_ids_mention_their_cell_at_most_twice():
    """Optimised plans repeat the expression; its own repetitions multiply with that."""
    cell = F.col("cell_of_the_card")
    assert str(ids.clean_id(cell, TEXT, CONFIG)).count("cell_of_the_card") <= 2
    assert str(ids.clean_id(cell, TEXT, LITERAL)).count("cell_of_the_card") == 1


def test_only_the_end_of_an_id_is_a_suffix(spark):
    values = ["1.0.0", "5.0 .0", "1.0x", "a.0\n", ".0.0", "0.0", "x\n.0", "None .0", "  "]
    cleaned = each(spark, lambda v: ids.clean_id(v, TEXT, CONFIG), values)
    assert cleaned == ["1.0", "5.0", "1.0x", "a.0\n", ".0", "0", "x\n", None, None]
    literal = each(spark, lambda v: ids.clean_id(v, TEXT, LITERAL), values)
    assert literal == ["1.0", "5.0", "1.0x", "a.0\n", ".0", "0", "x\n", "None", ""]


def _pairs(spark, function, rows):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, day date, event date")
    return [row[1] for row in frame.select("i", function(F.col("day"), F.col("event"))).orderBy("i").collect()]


def test_events_in_a_year(spark):
    rows = [
        (dt.date(2024, 3, 1), dt.date(1992, 2, 29)),
        (dt.date(2023, 3, 1), dt.date(1992, 2, 29)),
        (dt.date(2024, 5, 5), dt.date(2010, 3, 31)),
    ]
    kept = _pairs(spark, lambda day, event: dates.event_in_year(event, F.year(day)), rows)
    assert kept == [dt.date(2024, 2, 28), dt.date(2023, 2, 28), dt.date(2024, 3, 31)]
    capped = _pairs(spark, lambda day, event: dates.event_in_year_capped(event, F.year(day)), rows)
    assert capped == [dt.date(2024, 2, 28), dt.date(2023, 2, 28), dt.date(2024, 3, 28)]
    assert _pairs(spark, dates.event_gap, rows[:1]) == [2]


def test_event_window(spark):
    event = dt.date(1980, 6, 16)
    rows = [(dt.date(2024, 6, 16) + dt.timedelta(days=gap), event) for gap in (-16, -15, 0, 15, 16)]
    rows += [(dt.date(2024, 1, 3), dt.date(1980, 12, 28)), (dt.date(2024, 12, 30), dt.date(1980, 1, 5))]
    near = _pairs(spark, lambda d, e: dates.near_event(d, e, CONFIG), rows)
    assert near == [False, True, True, True, False, False, False]
    wrapped = replace(CONFIG, wrap_year_end=True)
    assert _pairs(spark, lambda d, e: dates.near_event(d, e, wrapped), rows)[-2:] == [True, True]
    assert _pairs(spark, dates.event_gap, rows[5:6]) == [-360]


@pytest.mark.parametrize("months", [1, 6, 36])
def test_first_after_against_search(spark, months):
    """For every day of eight years, the first day whose threshold lies after it."""
    days = spark.sql("SELECT explode(sequence(DATE '2019-01-01', DATE '2026-12-31')) AS day")
    found = days.select("day", dates.first_after(F.col("day"), months).alias("first"))
    checked = found.select(
        (F.add_months("first", -months) > F.col("day")).alias("is_past"),
        (F.add_months(F.date_sub("first", 1), -months) > F.col("day")).alias("day_before_is_past"),
    ).distinct().collect()
    assert checked == [(True, False)]


def test_month_keys(spark):
    values = [dt.date(2021, 4, 30), dt.date(2021, 10, 1)]
    assert each(spark, lambda v: dates.month_key(v, CONFIG), values, "date") == [dt.date(2021, 4, 1), values[1]]
    assert each(spark, lambda v: dates.month_key(v, LITERAL), values, "date") == ["2021-4", "2021-10"]


def test_config_checks_its_values():
    with pytest.raises(ValueError):
        replace(CONFIG, semantics="other")
    with pytest.raises(ValueError):
        replace(CONFIG, bad_number="skip")
    with pytest.raises(ValueError):
        replace(CONFIG, program_channels=())
    assert replace(CONFIG, focus_channel="STORE").focus_channel == "store"


def test_first_event_from_a_day(spark):
    """Against a walk over the calendar, around leap days and years without one."""
    leap_year, day = 2000, dt.timedelta(days=1)
    events = [dt.date(leap_year, m, d) for m, d in ((1, 1), (2, 28), (2, 29), (3, 1), (7, 15), (12, 31))]
    starts = [dt.date(y, m, d) for y in (1895, 1899, 1996, 2023, 2024, 2096) for m, d in ((1, 1), (2, 28), (3, 1), (7, 15), (7, 16), (12, 31))]
    rows = [(e, s) for e in events for s in [*starts, dt.date(2024, 2, 29)]]
    frame = spark.createDataFrame(rows, "e date, s date").select("e", "s", F.expr(dates.first_event_from("e", "s")).alias("first"))
    for event, start, first in frame.collect():
        while (start.month, start.day) != (event.month, event.day):
            start += day
        assert first == start, (event, start, first)
