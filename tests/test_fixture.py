"""The hand-worked fixture end to end, as raw text and as typed tables."""

import datetime as dt
from dataclasses import replace

import pytest

from daybook import Tables, daily
from daybook.config import CAMPAIGN_DECLARED, MEMBER_DECLARED, TRANSACTION_DECLARED
from daybook.operators import kpis
from daybook.plans.daily import COLUMNS
from daybook.sources.schemas import campaign_schema, conform, member_schema, transaction_schema
from tests import small

KPIS = {
    "newcustomercount": kpis.new_customers,
    "repeatcustomercount": kpis.repeat_customers,
    "totalcustomertransactions": kpis.total_customers,
    "newcustomersales": kpis.new_customer_sales,
    "repeatcustomersales": kpis.repeat_customer_sales,
    "transactedcustomersales": kpis.transacted_sales,
    "birthdaycustomercount": kpis.birthday_customers,
    "birthdaycustomersales": kpis.birthday_sales,
    "anncustomercount": kpis.anniversary_customers,
    "annvcustomersales": kpis.anniversary_sales,
    "customerbirthdaysperday": kpis.birthdays_per_day,
    "customeranniversariesperday": kpis.anniversaries_per_day,
    "enrolledcustomercount": kpis.enrolled_customers,
    "membersarchived": kpis.members_archived,
    "crosschannelbuyers": kpis.cross_channel_buyers,
    "diamondenthusiasts": kpis.keyword_buyers,
    "dormantcustomers": kpis.dormant_customers,
    "lowpointbalancecustomers": kpis.low_point_balance_customers,
    "activecustomers": kpis.active_customers,
    "campaignsdeployed": kpis.campaigns_deployed,
    "targetedcount": kpis.targeted_count,
    "buyers": kpis.campaign_buyers,
    "incrementalrev": kpis.incremental_revenue,
    "sale_value_1": kpis.campaign_details,
    "conversion_1": kpis.campaign_details,
    "channel": kpis.campaign_details,
    "brand": kpis.campaign_details,
    "region": kpis.campaign_details,
    "previousmonthbase": kpis.previous_month_base,
}


def check_daily(frame, expected):
    assert tuple(frame.columns) == COLUMNS
    rows = sorted(frame.collect(), key=lambda row: row["date"])
    assert [row["date"] for row in rows] == small.DAYS
    assert [row["id"] for row in rows] == list(range(10, 0, -1))
    for name, values in expected.items():
        got = [row[name] for row in rows]
        assert got == pytest.approx(values) if isinstance(got[0], float) else got == values, name


def check_measure(frame, name, values):
    """A measure's own frame: its days carry the value, the days it lacks have nothing to report."""
    rows = small.by_day(frame, name)
    blank = "N/A" if isinstance(values[0], str) else 0
    got = [blank if rows.get(day) is None else rows[day] for day in small.DAYS]
    assert got == pytest.approx(values) if isinstance(blank, int) else got == values
    assert frame.count() == len(rows)


def test_daily(spark):
    check_daily(daily(small.tables(spark), small.CONFIG), small.EXPECTED)


def test_daily_literal(spark):
    cfg = replace(small.CONFIG, semantics="reference")
    check_daily(daily(small.tables(spark, cfg), cfg), small.EXPECTED_LITERAL)


def test_schema(spark):
    frame = daily(small.tables(spark), small.CONFIG)
    kinds = dict(frame.dtypes)
    assert kinds["id"] == "int" and kinds["date"] == "date" and kinds["previousmonthbase"] == "int"
    doubles = {name for name, kind in frame.dtypes if kind == "double"}
    assert doubles == {
        "newcustomersales", "repeatcustomersales", "transactedcustomersales", "birthdaycustomersales",
        "annvcustomersales", "incrementalrev", "sale_value_1", "conversion_1",
        "targetedcount", "buyers",  # free text of any number of digits
    }
    assert {name for name, kind in frame.dtypes if kind == "string"} == {"channel", "brand", "region"}
    assert sum(kind == "bigint" for _, kind in frame.dtypes) == 31 - 3 - 3 - 10


@pytest.mark.parametrize("name", KPIS)
def test_measure(spark, name):
    check_measure(KPIS[name](small.tables(spark), small.CONFIG), name, small.EXPECTED[name])


@pytest.mark.parametrize("name", [n for n in KPIS if small.EXPECTED[n] != small.EXPECTED_LITERAL[n]])
def test_measure_literal(spark, name):
    cfg = replace(small.CONFIG, semantics="reference")
    values = small.EXPECTED_LITERAL[name]
    if name in ("newcustomersales", "transactedcustomersales"):
        # The day's total is NaN here; filling it is the consolidated frame's part.
        values = [float("nan") if i == 4 else value for i, value in enumerate(values)]
        rows = small.by_day(KPIS[name](small.tables(spark, cfg), cfg), name)
        assert [rows.get(day, 0) for day in small.DAYS] == pytest.approx(values, nan_ok=True)
    else:
        check_measure(KPIS[name](small.tables(spark, cfg), cfg), name, values)


def typed_tables(spark):
    """The fixture in the declared schemas: real dates, decimals and nulls instead of text."""
    cfg = replace(
        small.CONFIG,
        member_columns=MEMBER_DECLARED,
        transaction_columns=TRANSACTION_DECLARED,
        campaign_columns=CAMPAIGN_DECLARED,
    )
    members, transactions, campaigns = small.raw(spark)
    members = members.withColumnsRenamed({
        "enrollment_channel_code": "enrollmentchannelcode", "enrollment_date": "enrollmentdate",
        "point_balance": "pointbalance",
    })
    transactions = transactions.withColumnsRenamed({"card_no": "cardno", "eligible_amt": "eligible_amount"})
    campaigns = campaigns.withColumnsRenamed({
        "sale_value_1": "Sale_Value1", "conversion_1": "Conversion1",
    })
    return Tables(
        conform(members, member_schema("club")),
        conform(transactions, transaction_schema()),
        conform(campaigns, campaign_schema()),
        cfg,
    ), cfg


def test_daily_on_typed_tables(spark):
    tables, cfg = typed_tables(spark)
    assert dict(tables.transactions.dtypes)["amount"] == "double"
    check_daily(daily(tables, cfg), small.EXPECTED)


def test_base_overrides(spark):
    cfg = replace(small.CONFIG, base_overrides={dt.date(2024, 3, 1): 41250, dt.date(1999, 1, 1): 5})
    rows = small.by_day(daily(small.tables(spark, cfg), cfg), "previousmonthbase")
    assert {day: value for day, value in rows.items() if value} == {dt.date(2024, 3, 1): 41250}
    assert small.by_day(kpis.previous_month_base(small.tables(spark, cfg), cfg), "previousmonthbase") == rows


def test_bad_numbers_as_null(spark):
    cfg = replace(small.CONFIG, bad_number="null")
    rows = small.by_day(kpis.campaign_details(small.tables(spark, cfg), cfg), "conversion_1")
    assert rows[dt.date(2024, 2, 28)] == pytest.approx(0.2)


def test_wrapped_year_end(spark):
    rows = dict(
        members=[("1", "store", "2023-01-01", "1980-12-28", "None", "5")],
        transactions=[("1", "2024-01-03", "store", "Gold", "10")],
    )
    plain = replace(small.CONFIG, spine_start=dt.date(2024, 1, 1))
    assert kpis.birthday_customers(small.tables(spark, plain, **rows), plain).count() == 0
    wrapped = replace(plain, wrap_year_end=True)
    got = small.by_day(kpis.birthday_sales(small.tables(spark, wrapped, **rows), wrapped), "birthdaycustomersales")
    assert got == {dt.date(2024, 1, 3): 10.0}


def test_calendar_ends_with_focus_channel_or_enrollment(spark):
    """Later days of other channels are dropped; a purchase without a card still ends the calendar."""
    rows = dict(
        members=[("1", "store", "2024-02-27", "None", "None", "5")],
        transactions=[("1", "2024-03-09", "club", "Gold", "1"), ("None", "2024-03-02", "Store", "Gold", "1")],
        campaigns=[("2024-04-01", "1", "1", "1", "1", "1", "a", "b", "c")],
    )
    days = sorted(small.by_day(daily(small.tables(spark, **rows), small.CONFIG), "id"))
    assert (days[0], days[-1], len(days)) == (small.FIRST, dt.date(2024, 3, 2), 6)
    # History from before the calendar still decides who is new.
    rows["transactions"].append(("1", "2020-01-01", "club", "Gold", "1"))
    got = small.by_day(daily(small.tables(spark, **rows), small.CONFIG), "newcustomercount")
    assert sum(got.values()) == 0


@pytest.mark.parametrize("rows", [
    dict(members=[], transactions=[], campaigns=[]),
    dict(members=[("1", "store", "2020-01-01", "None", "None", "5")], transactions=[]),
])
def test_empty_calendar(spark, rows):
    """Nothing to end the calendar, or an end before its start."""
    tables = small.tables(spark, **rows)
    assert daily(tables, small.CONFIG).count() == 0
    assert kpis.members_archived(tables, small.CONFIG).count() == 0
