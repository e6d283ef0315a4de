"""From raw tables to the three typed tables all measures start from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from daybook.config import Config
from daybook.functions import dates, ids, numbers

RawTable = DataFrame | Callable[[], DataFrame]


class Tables:
    """Cleaned inputs of the daily measures.

    A raw table may be given as a function, which is called when a measure first needs the table.
    """

    #: Purchases by card and day, and one row per member card, where they are stored by card (``plans.clustered``).
    card_days: DataFrame | None = None
    cards: DataFrame | None = None

    def __init__(self, members: RawTable, transactions: RawTable, campaigns: RawTable, cfg: Config) -> None:
        self._members, self._transactions, self._campaigns = members, transactions, campaigns
        self._cfg = cfg

    @classmethod
    def from_clean(cls, members: DataFrame, transactions: DataFrame, campaigns: DataFrame) -> Tables:
        """Tables that are clean already, such as written copies of clean ones."""
        tables = cls.__new__(cls)
        tables.members, tables.transactions, tables.campaigns = members, transactions, campaigns
        return tables

    @cached_property
    def members(self) -> DataFrame:
        return clean_members(_raw(self._members), self._cfg)

    @cached_property
    def transactions(self) -> DataFrame:
        return clean_transactions(_raw(self._transactions), self._cfg)

    @cached_property
    def campaigns(self) -> DataFrame:
        return clean_campaigns(_raw(self._campaigns), self._cfg)


def _raw(table: RawTable) -> DataFrame:
    return table if isinstance(table, DataFrame) else table()


def _column(raw: DataFrame, name: str):
    return F.col(f"`{name}`"), raw.schema[name].dataType


def clean_members(raw: DataFrame, cfg: Config, keep: Sequence[str] = ()) -> DataFrame:
    """Members of the program's channels with a readable enrollment date. A card may be null. ``keep`` names columns
    to hand on as they are."""
    names = cfg.member_columns
    card, card_type = _column(raw, names["card_no"])
    balance, balance_type = _column(raw, names["point_balance"])
    return (
        raw.select(
            ids.clean_id(card, card_type, cfg).alias("card_no"),
            F.lower(f"`{names['channel']}`").alias("channel"),
            dates.to_day(F.col(f"`{names['enrollment_date']}`")).alias("enrollment_date"),
            dates.to_day(F.col(f"`{names['dob']}`")).alias("dob"),
            dates.to_day(F.col(f"`{names['anniversary']}`")).alias("anniversary"),
            numbers.points(balance, balance_type, cfg).alias("point_balance"),
            *keep,
        )
        .filter(F.col("channel").isin(*cfg.program_channels))
        .filter(F.col("enrollment_date").isNotNull())
    )


def clean_transactions(raw: DataFrame, cfg: Config, keep: Sequence[str] = ()) -> DataFrame:
    """Transactions with a readable date; channel and category in lower case, so that filters on written copies
    compare plain columns and reach the parquet scan.

    Rows without a card stay: the calendar may end on one of them. Every measure skips them.
    """
    names = cfg.transaction_columns
    card, card_type = _column(raw, names["card_no"])
    amount, amount_type = _column(raw, names["amount"])
    return raw.select(
        ids.clean_id(card, card_type, cfg).alias("card_no"),
        dates.to_day(F.col(f"`{names['invoice_date']}`")).alias("invoice_date"),
        F.lower(f"`{names['channel']}`").alias("channel"),
        F.lower(f"`{names['category']}`").alias("category"),
        numbers.amount(amount, amount_type, cfg).alias("amount"),
        numbers.amount_is_nonzero(amount, amount_type, cfg).alias("is_nonzero"),
        *keep,
    ).filter(F.col("invoice_date").isNotNull())


def clean_campaigns(raw: DataFrame, cfg: Config, keep: Sequence[str] = ()) -> DataFrame:
    """Campaigns with a readable deployment date."""
    names = cfg.campaign_columns
    deployed, deployed_type = _column(raw, names["deployment_date"])
    figure_type = "double" if cfg.literal else cfg.figure_type
    count_type = "int" if cfg.literal else "double"  # free text: any number of digits

    def figure(name):
        return numbers.guarded_decimal(F.col(f"`{names[name]}`"), figure_type, cfg.bad_number).alias(name)

    def count(name):
        return numbers.guarded_int(F.col(f"`{names[name]}`"), cfg.bad_number, count_type).alias(name)

    def label(name):
        return F.col(f"`{names[name]}`").alias(name)

    # The literal variant counts campaigns by another reading of the date than it adds them up.
    is_counted = F.lit(True)
    if cfg.literal:
        is_counted = dates.deployment_day_whole_text(deployed, deployed_type, cfg).isNotNull()
    return raw.select(
        dates.deployment_day(deployed, deployed_type, cfg).alias("deploy_date"),
        is_counted.alias("is_counted"),
        count("target_count"),
        count("buyers"),
        figure("incremental_rev"),
        figure("sale_value_1"),
        figure("conversion_1"),
        label("channel"),
        label("brand"),
        label("region"),
        *keep,
    ).filter(F.col("deploy_date").isNotNull())
