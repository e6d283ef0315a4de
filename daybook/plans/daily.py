"""The consolidated frame: every measure, one row per calendar day."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from daybook.config import Config
from daybook.operators import activity, campaigns, members
from daybook.operators.base import base_on
from daybook.operators.cards import EVENTS
from daybook.operators.population import running_total
from daybook.operators.spine import calendarise, number_rows
from daybook.sources.tables import Tables

# Columns of the consolidated frame, in order.
COLUMNS = (
    "id", "date",
    "newcustomercount", "repeatcustomercount", "newcustomersales", "repeatcustomersales",
    "birthdaycustomercount", "anncustomercount", "birthdaycustomersales", "annvcustomersales",
    "totalcustomertransactions", "transactedcustomersales",
    "customerbirthdaysperday", "customeranniversariesperday",
    "enrolledcustomercount", "membersarchived", "crosschannelbuyers", "diamondenthusiasts",
    "dormantcustomers", "lowpointbalancecustomers", "activecustomers",
    "campaignsdeployed", "targetedcount", "buyers", "incrementalrev", "previousmonthbase",
    "channel", "brand", "region", "sale_value_1", "conversion_1",
)
NO_LABEL = "N/A"


def fill_defaults(frame: DataFrame) -> DataFrame:
    """Days without a value: 0 for numbers (also for NaN), ``N/A`` for labels."""
    labels = [name for name in campaigns.LABELS if name in frame.columns]
    return frame.fillna(0).fillna(NO_LABEL, subset=labels)


def daily(tables: Tables, cfg: Config) -> DataFrame:
    """All 31 columns, lazily, with one scan of each table.

    The parts are stacked and grouped by date instead of joined to a calendar one by one: the
    calendar's end depends on the transactions, and a separate calendar would read them again.
    The literal results compare months as text, so that a card may stop counting on its birthdays: no running
    total gives them, and the members are read for them apart.
    """
    parts = [activity.activity_by_day(tables, cfg, measures(cfg)), campaigns.campaigns_by_day(tables.campaigns, cfg)]
    if cfg.literal:
        parts.append(members.enrolled_by_day(tables.members).withColumn(activity.ENROLLMENT_DAY, F.lit(True)))
    return consolidated(parts, lambda: tables.members, cfg)


def measures(cfg: Config) -> tuple[str, ...]:
    """The measures that one pass over purchases and members gives."""
    return activity.ALL if cfg.literal else activity.ALL + activity.ON_MEMBER_DAYS


def consolidated(parts: list[DataFrame], raw_members: Callable[[], DataFrame], cfg: Config) -> DataFrame:
    """The frame from its parts, which have at most one row per day each."""
    start = parts[0].sparkSession.range(1).select(F.lit(cfg.spine_start).alias("date"))
    parts = [*parts, start]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [name for name in stacked.columns if name != "date"]
    per_day = stacked.groupBy("date").agg(*[F.max(name).alias(name) for name in values])

    calendar = calendarise(per_day, cfg.spine_start, F.col(activity.FOCUS_DAY) | F.col(activity.ENROLLMENT_DAY))
    calendar = calendar.withColumns({name: running_total(name) for name in activity.STATE})
    if cfg.literal:
        calendar = members.events_on_calendar(calendar, raw_members(), {event: name for name, event in EVENTS.items()}, cfg)
    else:
        yearly = (F.month("date"), F.dayofmonth("date"))
        calendar = calendar.withColumns({name: running_total(name, *yearly) for name in EVENTS})
    calendar = calendar.withColumn("previousmonthbase", base_on(F.col("date"), cfg))
    return number_rows(fill_defaults(calendar)).select(*COLUMNS)
