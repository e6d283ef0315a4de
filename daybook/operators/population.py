"""How many cards are in a state on each day.

For states that a card never leaves: joining every day with every card that qualifies by then costs days x cards rows. Since a card
that qualifies once qualifies on every later day, it is enough to know its *entry day*: count the
entries per day and add them up along the calendar.

States that cards enter and leave are a sweep over +1 and -1 events: first by card, which joins its spells that
overlap or touch, then by day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_total(name: str, *groups: Column) -> Column:
    """Sum of a per-day column up to each day (of the same group); days without a value add nothing."""
    so_far = Window.partitionBy(*groups).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(F.coalesce(F.col(name), F.lit(0))).over(so_far)


def clamp_entry(entry: Column, first: dt.date) -> Column:
    """Cards that entered before the calendar starts are in from its first day."""
    return F.when(entry.isNotNull(), F.greatest(entry, F.lit(first)))


def population_by_day(entries: DataFrame, spine: DataFrame, first: dt.date, name: str) -> DataFrame:
    """From ``entries(card_no, entry)`` and a spine that starts on ``first`` to ``(date, name)``.

    One row per spine day. A card with several entries counts from its first one; null cards and
    null entries never count.
    """
    per_day = (
        entries.filter(F.col("card_no").isNotNull())
        .groupBy("card_no")
        .agg(F.min("entry").alias("entry"))
        .groupBy(clamp_entry(F.col("entry"), first).alias("date"))
        .agg(F.count("*").alias(name))
    )
    return spine.join(per_day, "date", "left").select("date", running_total(name).alias(name))


def population_in_spells(spells: DataFrame, spine: DataFrame, first: dt.date, name: str) -> DataFrame:
    """From ``spells(card_no, entry, exit)`` and a spine that starts on ``first`` to ``(date, name)``.

    A card is in the state from ``entry`` on and before ``exit`` (null: for good), once however many of its spells
    overlap. Null cards, null entries and spells that end before they begin never count. Events are combined on
    the map side by card and day, so a card with a third of all spells has at most a row per day when it is gathered.
    """
    entry, exit_ = F.col("entry"), F.col("exit")
    begin, end = clamp_entry(entry, first), clamp_entry(exit_, first)
    step = Window.partitionBy("card_no").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_ = F.col("open")
    flips = (
        spells.filter(F.col("card_no").isNotNull() & entry.isNotNull() & (exit_.isNull() | (exit_ > entry)))
        .select("card_no", F.inline(F.array(
            F.struct(begin.alias("date"), F.lit(1).alias("step")), F.struct(end.alias("date"), F.lit(-1).alias("step"))
        )))
        .filter(F.col("date").isNotNull())
        .groupBy("card_no", "date")
        .agg(F.sum("step").alias("step"))
        .withColumn("open", F.sum("step").over(step))
        .select("date", ((open_ > 0).cast("int") - (open_ > F.col("step")).cast("int")).alias("flip"))
    )
    per_day = flips.groupBy("date").agg(F.sum("flip").alias(name))
    return spine.join(per_day, "date", "left").select("date", running_total(name).alias(name))
