"""Measures that need members only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from daybook.config import Config
from daybook.functions.dates import month_and_day, month_key


def enrolled_by_day(members: DataFrame) -> DataFrame:
    """``(date, enrolledcustomercount)``: distinct cards per enrollment date, 0 where no row has a card."""
    return members.groupBy(F.col("enrollment_date").alias("date")).agg(
        F.count_distinct("card_no").alias("enrolledcustomercount")
    )


def events_by_month_day(members: DataFrame, events: Sequence[str], cfg: Config) -> DataFrame:
    """How many cards have a yearly event on a month and day, by the month of enrollment.

    At most 366 rows: ``month``, ``day`` and per event a list of ``(since, cards)``, which holds at
    most one entry per calendar month. A card counts from its first enrollment month on.
    """
    kinds = [
        F.struct(F.lit(event).alias("kind"), month_and_day(F.col(event)).alias("on")) for event in events
    ]
    per_card = (
        members.filter(F.col("card_no").isNotNull())
        .select("card_no", "enrollment_date", F.inline(F.array(*kinds)))
        .filter(F.col("on").isNotNull())
        .groupBy("card_no", "kind", "on")
        .agg(F.min(month_key(F.col("enrollment_date"), cfg)).alias("since"))
    )
    per_month = per_card.groupBy("kind", "on", "since").agg(F.count("*").alias("cards"))
    step = F.struct("since", "cards")
    return per_month.groupBy(F.month("on").alias("month"), F.dayofmonth("on").alias("day")).agg(
        *[F.collect_list(F.when(F.col("kind") == event, step)).alias(event) for event in events]
    )


def events_on_calendar(calendar: DataFrame, members: DataFrame, names: Mapping[str, str], cfg: Config) -> DataFrame:
    """Adds to each calendar day, for each ``event -> name``, the number of cards with the event on
    that day (29 February only in leap years) that enrolled in that month or earlier.

    The broadcast side has at most 366 rows, one per month and day, whatever the number of members.
    """
    events = events_by_month_day(members, list(names), cfg)
    same_day = (F.month("date") == F.col("month")) & (F.dayofmonth("date") == F.col("day"))
    joined = calendar.join(F.broadcast(events), same_day, "left").withColumn("_month", month_key(F.col("date"), cfg))

    def cards_so_far(event):
        enrolled = F.filter(event, lambda step: step["since"] <= F.col("_month"))
        cards = F.aggregate(enrolled, F.lit(0).cast("long"), lambda total, step: total + step["cards"])
        return F.coalesce(cards, F.lit(0))

    counted = joined.withColumns({name: cards_so_far(event) for event, name in names.items()})
    return counted.drop("month", "day", "_month", *names)
