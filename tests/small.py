"""A hand-worked fixture and helpers to build small inputs."""

from __future__ import annotations

import datetime as dt

from daybook import Config, Tables

FIRST = dt.date(2024, 2, 26)
DAYS = [FIRST + dt.timedelta(days=i) for i in range(10)]
CONFIG = Config(
    spine_start=FIRST,
    focus_channel="store",
    program_channels=("store", "club", "clubweb", "shopweb"),
    category_keyword="diamond",
)

MEMBER = "card_no string, enrollment_channel_code string, enrollment_date string, dob string, anniversary string, point_balance string"
MEMBER_ROWS = [
    ("1001.0", "STORE", "2024-02-27", "1992-02-29", "2010-03-15", "50"),
    ("1002", "Club", "2023-10-05 00:00:00", "1985-03-01", "NaT", "50.75"),
    (" 1003.0", "clubweb", "2020-01-10", "None", "2000-02-28", "12"),
    ("1002.0", "store", "2024-03-02", "1985-03-01", "NaT", "10"),
    ("None", "store", "2024-03-01", "None", "None", "5"),
    ("1006", "kiosk", "2024-02-28", "1990-03-01", "None", "10"),
    ("1007", "shopweb", "bad-date", "1990-03-01", "None", "90"),
    ("1008", "store", "2023-01-01", "1980-01-05", "1999-12-28", "60"),
]
TRANSACTION = "card_no string, invoice_date string, channel string, category string, eligible_amt string"
TRANSACTION_ROWS = [
    ("1001", "2024-02-28", "store", "Diamond Ring", "100"),
    ("1001.0", "2024-03-01", "STORE", "Gold", "50.5"),
    ("1002", "2024-02-26", "other", "Gold", "20"),
    ("1002", "2024-03-02", "store", "diamond", "0.5"),
    ("1003", "2020-06-15", "store", "Gold", "80"),
    ("1006", "2024-03-01", "store", "diamond", "nan"),
    ("1006", "2024-03-06", "store", "Gold", "0"),
    ("None", "2024-03-01", "store", "Gold", "999"),
    ("1002", "2023-08-31", "club", "Gold", "10"),
    ("1008", "2023-08-30", "store", "Gold", "40"),
    ("1008", "not a date", "store", "Gold", "7"),
]
CAMPAIGN = (
    "deployment_date string, target_count string, buyers string, incremental_rev string, sale_value_1 string, "
    "conversion_1 string, channel string, brand string, region string"
)
CAMPAIGN_ROWS = [
    ("2024-02-28", "100", "5", "12.5", "200", "0.10", "SMS", "A", "N"),
    ("28-02-2024", " 50 ", "1,200", "-2.5", "12%", "0.30", "Email", "A", None),
    ("2024-02-28 09:30:00", "x", "2", "", "1.5", "n/a", "SMS", "B", "N"),
    ("28-02-2024 09:30:00", "7", "1", "1", "1", "0.20", "Push", "B", "S"),
    ("2024/02/28", "9", "9", "9", "9", "9", "SMS", "C", "S"),
    ("31-02-2024", "9", "9", "9", "9", "9", "SMS", "C", "S"),
    ("2024-03-05", "10", "0", "0", "0", "0", None, None, None),
]

# Measure -> value on each of the ten days.
EXPECTED = {
    "newcustomercount": [0, 0, 1, 0, 1, 0, 0, 0, 0, 0],
    "repeatcustomercount": [1, 0, 0, 0, 1, 1, 0, 0, 0, 1],
    "totalcustomertransactions": [1, 0, 1, 0, 2, 1, 0, 0, 0, 1],
    "newcustomersales": [0, 0, 100, 0, 0, 0, 0, 0, 0, 0],
    "repeatcustomersales": [20, 0, 0, 0, 50.5, 0.5, 0, 0, 0, 0],
    "transactedcustomersales": [20, 0, 100, 0, 50.5, 0.5, 0, 0, 0, 0],
    "birthdaycustomercount": [1, 0, 1, 0, 1, 1, 0, 0, 0, 0],
    "birthdaycustomersales": [20, 0, 100, 0, 50.5, 0.5, 0, 0, 0, 0],
    "anncustomercount": [0, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    "annvcustomersales": [0, 0, 0, 0, 50.5, 0, 0, 0, 0, 0],
    "customerbirthdaysperday": [0, 0, 0, 1, 1, 0, 0, 0, 0, 0],
    "customeranniversariesperday": [0, 0, 1, 0, 0, 0, 0, 0, 0, 0],
    "enrolledcustomercount": [0, 1, 0, 0, 0, 1, 0, 0, 0, 0],
    "membersarchived": [1] * 10,
    "crosschannelbuyers": [0, 0, 1, 0, 0, 1, 0, 0, 0, 0],
    "diamondenthusiasts": [0, 0, 1, 0, 0, 1, 0, 0, 0, 0],
    "dormantcustomers": [0, 0, 0, 0, 1, 1, 1, 1, 1, 1],
    "lowpointbalancecustomers": [1, 1, 1, 1, 1, 2, 2, 2, 2, 2],
    "activecustomers": [0, 0, 1, 0, 1, 1, 0, 0, 0, 0],
    "campaignsdeployed": [0, 0, 4, 0, 0, 0, 0, 0, 1, 0],
    "targetedcount": [0, 0, 157, 0, 0, 0, 0, 0, 10, 0],
    "buyers": [0, 0, 8, 0, 0, 0, 0, 0, 0, 0],
    "incrementalrev": [0, 0, 11, 0, 0, 0, 0, 0, 0, 0],
    "sale_value_1": [0, 0, 202.5, 0, 0, 0, 0, 0, 0, 0],
    "conversion_1": [0, 0, 0.15, 0, 0, 0, 0, 0, 0, 0],
    "previousmonthbase": [0] * 10,
    "channel": ["N/A", "N/A", "Email, Push, SMS", *["N/A"] * 7],
    "brand": ["N/A", "N/A", "A, B", *["N/A"] * 7],
    "region": ["N/A", "N/A", "N, S", *["N/A"] * 7],
}


def _with(name: str, changes: dict[int, object]) -> list:
    values = list(EXPECTED[name])
    for position, value in changes.items():
        values[position] = value
    return values


# Where the literal results differ (positions count from 2024-02-26).
EXPECTED_LITERAL = EXPECTED | {
    **{name: [0] * 10 for name in (
        "birthdaycustomercount", "birthdaycustomersales", "anncustomercount", "annvcustomersales")},
    "crosschannelbuyers": _with("crosschannelbuyers", {5: 2}),
    "newcustomercount": _with("newcustomercount", {4: 2}),
    "totalcustomertransactions": _with("totalcustomertransactions", {4: 3}),
    "newcustomersales": _with("newcustomersales", {4: 0}),
    "transactedcustomersales": _with("transactedcustomersales", {4: 0}),
    "enrolledcustomercount": _with("enrolledcustomercount", {4: 1}),
    "lowpointbalancecustomers": [1, 1, 1, 1, 2, 3, 3, 3, 3, 3],
    "activecustomers": _with("activecustomers", {4: 2, 5: 0}),
    "campaignsdeployed": _with("campaignsdeployed", {2: 3}),
    "targetedcount": _with("targetedcount", {2: 150}),
    "buyers": _with("buyers", {2: 7}),
    "incrementalrev": _with("incrementalrev", {2: 10}),
    "sale_value_1": _with("sale_value_1", {2: 201.5}),
    "conversion_1": _with("conversion_1", {2: 0.4 / 3}),
    "channel": ["N/A", "N/A", "Email, SMS", *["N/A"] * 5, "", "N/A"],
    "brand": ["N/A", "N/A", "A, B", *["N/A"] * 5, "", "N/A"],
    "region": ["N/A", "N/A", "N", *["N/A"] * 5, "", "N/A"],
}


def raw(spark, members=MEMBER_ROWS, transactions=TRANSACTION_ROWS, campaigns=CAMPAIGN_ROWS):
    return (
        spark.createDataFrame(members, MEMBER),
        spark.createDataFrame(transactions, TRANSACTION),
        spark.createDataFrame(campaigns, CAMPAIGN),
    )


def tables(spark, cfg=CONFIG, **rows) -> Tables:
    return Tables(*raw(spark, **rows), cfg)


def by_day(frame, name: str) -> dict:
    return {row["date"]: row[name] for row in frame.collect()}
