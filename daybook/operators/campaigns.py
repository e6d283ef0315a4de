"""Campaign totals per deployment day, all in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daybook.config import Config
from daybook.functions import exact

LABELS = ("channel", "brand", "region")


FIGURES = ("target_count", "buyers", "incremental_rev", "sale_value_1", "conversion_1")


def _joined(labels: Column, cfg: Config) -> Column:
    """Distinct labels in text order. No label at all is null (literal variant: empty text)."""
    joined = F.concat_ws(", ", F.sort_array(labels))
    return joined if cfg.literal else F.nullif(joined, F.lit(""))


def campaigns_by_day(campaigns: DataFrame, cfg: Config, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per deployment day: campaigns, targets, buyers, revenue, sales, mean conversion, labels.

    With labels, rows are added up per day and label combination first, so that the label sets of a day with
    very many campaigns are built from its distinct combinations instead of its rows.
    """
    totals = _exact_totals if cfg.exact_figures else _plain_totals
    return with_names(totals(campaigns.withColumn("date", F.col("deploy_date")), labels), cfg, labels)


def _plain_totals(campaigns: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Counts, sums of the figures and label lists per day."""
    sums = [F.sum(name).alias(name) for name in FIGURES]
    counts = [F.count_if("is_counted").alias("campaignsdeployed"), F.count("conversion_1").alias("conversions")]
    partial = campaigns.groupBy("date", *labels).agg(*counts, *sums)
    if not labels:
        return partial
    again = [F.sum(name).alias(name) for name in ("campaignsdeployed", "conversions", *FIGURES)]
    return partial.groupBy("date").agg(*again, *[F.collect_set(name).alias(name) for name in labels])


def _exact_totals(campaigns: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The same with sums that do not depend on the order of the rows (``functions.exact``).

    The figures are stacked, so that one set of sums serves all of them: by day, labels, figure and bin first, of which
    a day and figure nearly always has one, then by day.
    """
    partial = stacked_figures(campaigns, labels).groupBy("date", *labels, "figure", "value_bin").agg(*_sums())
    return totals_of_partials(partial, labels)


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("campaignsdeployed", "conversions")] + exact.summed("value")


def stacked_figures(campaigns: DataFrame, labels: Sequence[str], *others: str) -> DataFrame:
    """A row per campaign and figure, with the parts of the figure's value."""
    figure = F.col("figure")
    spread = campaigns.withColumn("figure", F.explode(F.array(*[F.lit(name) for name in FIGURES])))
    value = F.coalesce(*[F.when(figure == name, F.col(name)) for name in FIGURES])
    # a campaign counts in the row of one figure only
    stacked = spread.select(
        "date", *labels, "figure", value.alias("value"),
        ((figure == FIGURES[0]) & F.col("is_counted")).cast("long").alias("campaignsdeployed"),
        ((figure == "conversion_1") & F.col("conversion_1").isNotNull()).cast("long").alias("conversions"), *others,
    )
    return exact.with_parts(exact.with_bin(stacked, "value"), "value")


def campaign_changes(campaigns: DataFrame, change: str) -> DataFrame:
    """Partial sums by day, labels, figure and bin that add up: ``change`` is 1 for a campaign that comes, -1 for one that goes."""
    rows = stacked_figures(campaigns.withColumn("date", F.col("deploy_date")), LABELS, change)
    sign = F.col(change).cast("long")
    sums = ("campaignsdeployed", "conversions", *[f"value_{part}" for part in exact.PARTS])
    return rows.groupBy("date", *LABELS, "figure", "value_bin").agg(
        F.sum(sign).alias("rows"), *[F.sum(F.col(name) * sign).alias(name) for name in sums]
    )


def partials_of_changes(changes: DataFrame) -> DataFrame:
    """The partial sums that a pile of changes amounts to."""
    keys = ("date", *LABELS, "figure", "value_bin")
    sums = [F.sum(name).alias(name) for name in changes.columns if name not in keys]
    return changes.groupBy(*keys).agg(*sums).where("rows <> 0").drop("rows")


def totals_of_partials(partial: DataFrame, labels: Sequence[str]) -> DataFrame:
    if labels:
        sets = [F.collect_set(name).alias(name) for name in labels]
        partial = partial.groupBy("date", "figure", "value_bin").agg(*_sums(), *sets)
    counts = [F.sum(name).alias(name) for name in ("campaignsdeployed", "conversions")]
    sums = [column for name in FIGURES for column in exact.group_sums(name, "value", f"figure = '{name}'")]
    lists = [F.array_distinct(F.flatten(F.collect_list(name))).alias(name) for name in labels]
    return exact.finish(partial.groupBy("date").agg(*counts, *sums, *lists), *FIGURES)


def with_names(totals: DataFrame, cfg: Config, labels: Sequence[str]) -> DataFrame:
    """The totals under the names of the measures."""
    return totals.select(
        "date", "campaignsdeployed", F.col("target_count").alias("targetedcount"), "buyers",
        F.col("incremental_rev").cast("double").alias("incrementalrev"),
        F.col("sale_value_1").cast("double").alias("sale_value_1"),
        F.try_divide(F.col("conversion_1").cast("double"), "conversions").alias("conversion_1"),
        *[_joined(F.col(name), cfg).alias(name) for name in labels],
    )
