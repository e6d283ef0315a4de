"""The consolidated frame kept up to date from changes, without reading the old rows again.

    changes -> cards they touch -> those cards' contributions before and after -> difference per day
                                                                                      |
    state (purchases by card and day, members, campaigns by day, contributions by day) ┴ frame

All that is kept adds up: counts, and sums as whole-number parts (``functions.exact``). A row that goes takes away exactly
what it had added, late rows just come later, and a corrected row is one that goes and one that comes. A refresh
appends its changes to the state; it computes purchases and history of the cards it touches only, and of the days
only those on which these cards' contributions change. Where a load touches most cards, all cards are computed once and held
against the days so far, which is half the work and gives the same difference. The frame is made from the days.

Each refresh has a number and writes below it, so one that is run again after a failure replaces its own part. It reads
only parts with smaller numbers. ``compact`` writes the state as one part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.config import Config
from daybook.operators import activity, campaigns
from daybook.operators.cards import card_day_changes, card_days_of_changes, member_cards_with_days
from daybook.plans.daily import consolidated, measures
from daybook.sources.tables import clean_campaigns, clean_members, clean_transactions

# Column of the changes: 1 for a row that comes, -1 for a row that goes.
CHANGE = "change"
_LOG = "refresh"
_PURCHASE_KEYS = ("card_no", "date", "amount_bin")
_MEMBER = ("card_no", "channel", "enrollment_date", "dob", "anniversary", "point_balance")
_DAY_KEYS = ("on", "kind", "is_first", "near_birthday", "near_anniversary", "amount_bin")
_CAMPAIGN_KEYS = ("date", *campaigns.LABELS, "figure", "value_bin")
_KEYS = {"purchases": _PURCHASE_KEYS, "members": _MEMBER, "days": _DAY_KEYS, "campaigns": _CAMPAIGN_KEYS}


class DailyState:
    """The state below ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, cfg: Config) -> None:
        if cfg.literal or not (cfg.exact_amounts and cfg.exact_figures):
            raise ValueError("a state needs corrected results and sums of doubles: others cannot be taken away again")
        self.spark, self.path, self.cfg = spark, path.rstrip("/"), cfg

    def refresh(self, members: DataFrame, transactions: DataFrame, campaign_rows: DataFrame, number: int) -> None:
        """Adds raw changes: the raw columns and ``change``. Numbers start at 0 and rise."""
        cfg = self.cfg
        purchases = self._write(card_day_changes(clean_transactions(transactions, cfg, [CHANGE]), cfg, CHANGE), "purchases", number)
        rows = F.sum(F.col(CHANGE).cast("long")).alias("rows")
        changed = clean_members(members, cfg, [CHANGE]).groupBy(*_MEMBER).agg(rows).where("rows <> 0")
        changed = self._write(changed, "members", number)
        self._write(campaigns.campaign_changes(clean_campaigns(campaign_rows, cfg, [CHANGE]), CHANGE), "campaigns", number)

        touched = purchases.select("card_no").union(changed.select("card_no"))
        self._write(self._moved(touched, number), "days", number)

    def _moved(self, touched: DataFrame, number: int) -> DataFrame:
        """What a refresh changes on the days; both ways give the same rows, since all that is added up are whole numbers."""
        if number == 0:
            return self._contributions(number + 1)
        if self._are_most(touched, number):
            before, after = _added(self._read("days", number), "days"), self._contributions(number + 1)
        else:
            before, after = [self._contributions(below, touched.distinct()) for below in (number, number + 1)]
        values = [name for name in after.columns if name not in _DAY_KEYS]
        taken = before.select(*_DAY_KEYS, *[(-F.col(name)).alias(name) for name in values])
        return _added(after.unionByName(taken), "days")

    def _are_most(self, touched: DataFrame, number: int) -> bool:
        """Whether one pass over all cards is less work than two over the touched ones; about, since either is right."""
        cards = [self._read(name, number + 1).select("card_no") for name in ("purchases", "members")]
        counts = [rows.agg(F.approx_count_distinct("card_no")).first()[0] for rows in (touched, cards[0].union(cards[1]))]
        return 2 * counts[0] > counts[1]

    def frame(self) -> DataFrame:
        """The consolidated frame of all refreshes so far."""
        asked = list(measures(self.cfg))
        days = activity.by_day(_added(self._read("days"), "days"), asked, in_parts=True)
        totals = campaigns.totals_of_partials(campaigns.partials_of_changes(self._read("campaigns")), campaigns.LABELS)
        return consolidated([days, campaigns.with_names(totals, self.cfg, campaigns.LABELS)], self._members, self.cfg)

    def compact(self, path: str) -> DailyState:
        """The same state as one part in another folder, under number 0; go on there with 1."""
        other = DailyState(self.spark, path, self.cfg)
        for name in _KEYS:
            other._write(_added(self._read(name), name), name, 0)
        return other

    def _contributions(self, below: int, touched: DataFrame | None = None) -> DataFrame:
        """What the touched cards, or all, add to each day by the refreshes with smaller numbers."""
        rows = self._read("purchases", below)
        days = card_days_of_changes(rows if touched is None else _of(rows, touched), self.cfg)
        cards = member_cards_with_days(self._members(below, touched), self.cfg)
        return activity.contributions(days, lambda with_days: cards, self.cfg, list(measures(self.cfg)), in_parts=True)

    def _members(self, below: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        rows = self._read("members", below)
        rows = rows if touched is None else _of(rows, touched)
        return _added(rows, "members").where("rows > 0").drop("rows")

    def _write(self, rows: DataFrame, name: str, number: int) -> DataFrame:
        path = f"{self.path}/{name}/{_LOG}={number}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _read(self, name: str, below: int | None = None) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/{name}")
        return (rows if below is None else rows.where(F.col(_LOG) < below)).drop(_LOG)


def _of(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of the touched cards, among which may be the missing one."""
    cards = touched.withColumnRenamed("card_no", "touched")
    return rows.join(cards, rows["card_no"].eqNullSafe(cards["touched"]), "left_semi")


def _added(rows: DataFrame, name: str) -> DataFrame:
    """One row per key with the sums of all numbers; keys for which nothing is left go."""
    values = [column for column in rows.columns if column not in _KEYS[name]]
    sums = rows.groupBy(*_KEYS[name]).agg(*[F.sum(value).alias(value) for value in values])
    return sums.where(" OR ".join(f"{value} <> 0" for value in values))
