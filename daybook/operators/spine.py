"""The gapless calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.config import Config
from daybook.sources.tables import Tables


def spine_bounds(tables: Tables, cfg: Config) -> DataFrame:
    """One row ``(first, last)``: the set start and the later of the last enrollment and the last
    transaction in the focus channel. ``last`` is null when there is neither."""
    enrolled = tables.members.select(F.col("enrollment_date").alias("date"))
    bought = tables.transactions.filter(F.col("channel") == cfg.focus_channel).select(
        F.col("invoice_date").alias("date")
    )
    return enrolled.union(bought).agg(F.lit(cfg.spine_start).alias("first"), F.max("date").alias("last"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included; no rows when ``last`` is earlier or null."""
    days = F.when(F.col("last") >= F.col("first"), F.sequence("first", "last"))
    return bounds.select(F.explode(days).alias("date"))


def calendarise(frame: DataFrame, first: dt.date, is_end: Column) -> DataFrame:
    """Gapless calendar around a frame with one row per date, in a single pass over the frame.

    The calendar runs from ``first`` to the last date for which ``is_end`` holds. Days the frame
    lacks get nulls, days outside the calendar are dropped. ``frame`` must hold the date ``first``.

    The windows run in one task: a frame has at most one row per calendar day by then.
    """
    values = [name for name in frame.columns if name != "date"]
    known = (
        frame.withColumn("_last", F.max(F.when(is_end, F.col("date"))).over(Window.partitionBy()))
        .filter(F.col("date").between(F.lit(first), F.col("_last")))
        .withColumn("_next", F.lead("date").over(Window.orderBy("date")))
    )
    until = F.coalesce(F.date_sub("_next", 1), F.col("_last"))
    return known.withColumn("_day", F.explode(F.sequence(F.col("date"), until))).select(
        F.col("_day").alias("date"),
        *[F.when(F.col("_day") == F.col("date"), F.col(name)).alias(name) for name in values],
    )


def number_rows(frame: DataFrame) -> DataFrame:
    """``id`` counts from the newest day (1) back; one task, one row per calendar day."""
    return frame.withColumn("id", F.row_number().over(Window.orderBy(F.desc("date"))))
