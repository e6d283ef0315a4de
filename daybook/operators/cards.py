"""The two reductions every card-level measure starts from.

Skew: a hot card may hold a third of all rows. Both reductions combine on the map side, and the
first one groups by card *and* day, so a hot card is spread over its days. What is left afterwards
is at most one row per card and calendar day, and one row per card: small enough to gather by card.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.config import Config
from daybook.functions import exact
from daybook.functions.dates import first_event_from, month_and_day

# Measure of the days of enrollment, and measures of yearly events.
ENROLLED = "enrolledcustomercount"
EVENTS = {"customerbirthdaysperday": "dob", "customeranniversariesperday": "anniversary"}


def _any(condition: Column) -> Column:
    return F.bool_or(F.coalesce(condition, F.lit(False)))


def card_days(transactions: DataFrame, cfg: Config) -> DataFrame:
    """One row per card and day: the amount and what kind of purchases there were.

    A row whose channel is unknown counts neither as the focus channel nor as ``elsewhere``.
    """
    return _per_card_day(transactions, cfg, [], [F.sum("amount").alias("amount")])


def card_days_in_parts(transactions: DataFrame, cfg: Config) -> DataFrame:
    """As ``card_days``, with the amounts as parts of order-free sums (``functions.exact``).

    The row of ``amount_bin`` 0 has the facts of the card and day. Amounts far beyond the usual sizes have rows of
    their own in other bins, which carry these amounts and nothing else.
    """
    return _per_card_day(_apart(transactions), cfg, ["amount_bin"], exact.summed("amount"))


def _apart(transactions: DataFrame) -> DataFrame:
    """The rows with the parts of their amounts; a row with an amount in another bin than 0 is two, see above."""
    usual, main = F.col("amount_bin") == 0, F.col("is_main")
    one, two = F.array(F.lit(True)), F.array(F.lit(True), F.lit(False))
    rows = exact.with_bin(transactions, "amount").withColumn("is_main", F.explode(F.when(usual, one).otherwise(two)))
    apart = rows.withColumns({
        "amount": F.when(usual | ~main, F.col("amount")),
        "amount_bin": F.when(main, 0).otherwise(F.col("amount_bin")),
        "channel": F.when(main, F.col("channel")),
    })
    return exact.with_parts(apart, "amount")


def _facts(cfg: Config) -> dict[str, Column]:
    """What kind of purchase a row is."""
    channel = F.col("channel")
    in_focus = channel == cfg.focus_channel
    return {
        "in_focus": in_focus,
        "elsewhere": channel != cfg.focus_channel,
        "keyword_in_focus": in_focus & F.col("category").contains(cfg.category_keyword),
        "spent_in_focus": in_focus & F.col("is_nonzero"),
        "spent_in_program": channel.isin(*cfg.program_channels) & F.col("is_nonzero"),
    }


def _per_card_day(transactions: DataFrame, cfg: Config, keys: list[str], sums: list[Column]) -> DataFrame:
    facts = [_any(condition).alias(name) for name, condition in _facts(cfg).items()]
    return transactions.groupBy("card_no", F.col("invoice_date").alias("date"), *keys).agg(*sums, *facts)


def card_day_changes(transactions: DataFrame, cfg: Config, change: str) -> DataFrame:
    """As ``card_days_in_parts``, but counts instead of facts, so that changes add up: ``change`` is 1 for a row that comes and
    -1 for one that goes. ``rows`` counts a day's purchases, in other bins than 0 its amounts."""
    sign = F.col(change).cast("long")
    rows = _apart(transactions)
    parts = [F.sum(F.col(f"amount_{part}") * sign).alias(f"amount_{part}") for part in exact.PARTS]
    facts = [F.sum(F.when(condition, sign).otherwise(0)).alias(name) for name, condition in _facts(cfg).items()]
    return rows.groupBy("card_no", F.col("invoice_date").alias("date"), "amount_bin").agg(F.sum(sign).alias("rows"), *parts, *facts)


def card_days_of_changes(changes: DataFrame, cfg: Config) -> DataFrame:
    """The card-days that a pile of changes amounts to."""
    counts = [name for name in changes.columns if name not in ("card_no", "date", "amount_bin")]
    added = changes.groupBy("card_no", "date", "amount_bin").agg(*[F.sum(name).alias(name) for name in counts])
    facts = {name: F.col(name) > 0 for name in _facts(cfg)}
    return added.where("rows <> 0").withColumns(facts).drop("rows")


def with_history(days: DataFrame, following: bool = False) -> DataFrame:
    """Adds to each card-day the card's first and last days of several kinds, and if asked its next days of two kinds."""
    card = Window.partitionBy("card_no")
    # from the last day back, so that the frame only grows
    later = card.orderBy(-F.unix_date("date")).rangeBetween(Window.unboundedPreceding, -1)
    following_days = {
        "next_day": F.min("date").over(later),
        "next_focus_spend_day": F.min(F.when(F.col("spent_in_focus"), F.col("date"))).over(later),
    }

    def first_day(condition):
        return F.min(F.when(condition, F.col("date"))).over(card)

    return days.select(
        "*",
        F.min("date").over(card).alias("first_day"),
        F.max("date").over(card).alias("last_day"),
        first_day(F.col("in_focus")).alias("first_focus_day"),
        first_day(F.col("elsewhere")).alias("first_elsewhere_day"),
        F.max(F.when(F.col("spent_in_focus"), F.col("date"))).over(card).alias("last_focus_spend_day"),
        *[day.alias(name) for name, day in following_days.items() if following],
    )


def member_cards(members: DataFrame, cfg: Config) -> DataFrame:
    """One row per member card; a card with several member rows has the facts of all of them.

    The two sets hold month and day only, so they have at most 366 entries each.
    """
    return _per_member_card(members.filter(F.col("card_no").isNotNull()), cfg)


def member_cards_with_days(members: DataFrame, cfg: Config) -> DataFrame:
    """As ``member_cards``, with the days on which the card adds to a measure of its own: ``member_days`` lists
    ``(kind, on)``, each day of enrollment and, for each yearly event, the first day on which it counts.

    A card counts on every later day of the event as well, so the measure is a running total over the days of that month
    and day. Rows without a card are one more row, which has nothing but their days of enrollment.
    """
    month = F.trunc("enrollment_date", "month")
    since = {
        kind: F.collect_set(F.when(F.col(event).isNotNull(), F.struct(month_and_day(F.col(event)).alias("on"), month.alias("since"))))
        for kind, event in EVENTS.items()
    }
    known = F.col("card_no").isNotNull()
    cards = _per_member_card(
        members, cfg, [F.collect_set("enrollment_date").alias(ENROLLED), *[c.alias(kind) for kind, c in since.items()]]
    )
    start = f"greatest(array_min(transform(filter({{0}}, s -> s.on = e), s -> s.since)), DATE '{cfg.spine_start}')"
    days = [f"transform({ENROLLED}, d -> named_struct('kind', '{ENROLLED}', 'on', d))"]
    for kind in EVENTS:
        first = first_event_from("e", start.format(kind))
        distinct = f"array_distinct(transform({kind}, s -> s.on))"
        days.append(f"transform({distinct}, e -> named_struct('kind', '{kind}', 'on', {first}))")
    facts = {name: F.when(known, F.col(name)) for name in ("enrolled", "low_points_since", "holds_points")}
    listed = F.when(known, F.expr(f"concat({', '.join(days)})")).otherwise(F.expr(days[0]))
    return cards.withColumns({**facts, "member_days": listed}).drop(ENROLLED, *EVENTS)


def _per_member_card(members: DataFrame, cfg: Config, more: list[Column] = ()) -> DataFrame:
    points = F.col("point_balance")
    return (
        members.groupBy("card_no")
        .agg(
            *more,
            F.min("enrollment_date").alias("enrolled"),
            F.min(F.when(points < cfg.point_threshold, F.col("enrollment_date"))).alias("low_points_since"),
            _any(points > cfg.point_threshold).alias("holds_points"),
            F.collect_set(month_and_day(F.col("dob"))).alias("birthdays"),
            F.collect_set(month_and_day(F.col("anniversary"))).alias("anniversaries"),
        )
    )
