"""All measures that need transactions, in one pass over them.

    transactions -> card-days -> history by card -> joined with member cards -> per day

Three kinds of measure share the pass: *sales* need card-days only, *member* measures also the
member's row, and *state* measures one entry day per card, which is added up along the calendar
later (see ``operators.population``). Only the parts that the asked measures need are planned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from daybook.config import Config
from daybook.functions import exact
from daybook.functions.dates import first_after, near_event
from daybook.operators.cards import (
    ENROLLED, EVENTS, card_days, card_days_in_parts, member_cards, member_cards_with_days, with_history,
)
from daybook.operators.population import clamp_entry
from daybook.sources.tables import Tables

SALES = (
    "newcustomercount", "repeatcustomercount", "totalcustomertransactions",
    "newcustomersales", "repeatcustomersales", "transactedcustomersales",
)
MEMBER = (
    "birthdaycustomercount", "birthdaycustomersales", "anncustomercount", "annvcustomersales",
    "crosschannelbuyers", "diamondenthusiasts", "activecustomers",
)
STATE = ("membersarchived", "dormantcustomers", "lowpointbalancecustomers")
ALL = SALES + MEMBER + STATE
# Measures that need members only; here they come out of the same pass over them.
ON_MEMBER_DAYS = (ENROLLED, *EVENTS)

_AMOUNTS = {name for name in ALL if name.endswith("sales")}

# Name of the column that marks the days on which the calendar may end.
FOCUS_DAY = "is_focus_day"
ENROLLMENT_DAY = "is_enrollment_day"

# What a row speaks for: a card's purchases on its own day, purchases without a card, or (under the
# name of a state measure) the day on which a card enters a state.
_PURCHASE = "purchase"
_NO_CARD = "no card"

# Facts about a card-day that split both its card count and its amount.
_SPLITS = {
    "is_first": {"newcustomercount", "repeatcustomercount", "newcustomersales", "repeatcustomersales"},
    "near_birthday": {"birthdaycustomercount", "birthdaycustomersales"},
    "near_anniversary": {"anncustomercount", "annvcustomersales"},
}


def _split(name: str, cfg: Config) -> Column:
    if name == "is_first":
        return F.col("date") == F.col("first_day")
    if cfg.literal:
        # The replaced job loses the day of purchases near an event, so none reaches the calendar.
        return F.lit(False)
    events = {"near_birthday": "birthdays", "near_anniversary": "anniversaries"}[name]
    return F.coalesce(F.exists(events, lambda event: near_event(F.col("date"), event, cfg)), F.lit(False))


def first_focus_reasons(cfg: Config) -> Column:
    """How many reasons a card has to count as a cross-channel buyer on its first focus-channel day.

    Bought elsewhere before, or enrolled before: one reason at most, unless the literal results are
    wanted, which count a card with both reasons twice.
    """
    first_focus = F.col("first_focus_day")
    bought_elsewhere = F.coalesce(F.col("first_elsewhere_day") < first_focus, F.lit(False))
    enrolled_before = F.coalesce(F.col("enrolled") < first_focus, F.lit(False))
    if cfg.literal:
        return bought_elsewhere.cast("int") + enrolled_before.cast("int")
    return (bought_elsewhere | enrolled_before).cast("int")


def _entry_day(name: str, cfg: Config) -> Column:
    """The day from which a card is in a state, null if never. Evaluated once per card."""
    if name == "membersarchived":
        lapsed = first_after(F.col("last_day"), cfg.archive_months)  # null without any purchase
        return F.when(F.col("enrolled").isNotNull(), F.greatest(F.col("enrolled"), lapsed))
    if name == "dormantcustomers":
        return F.when(F.col("holds_points"), first_after(F.col("last_focus_spend_day"), cfg.dormant_months))
    return F.col("low_points_since")


def _spells(name: str, cfg: Config) -> list[tuple[Column, Column, Column]]:
    """When a row of a card begins and ends spells in a state that the card leaves when it buys: condition, entry, exit (null:
    for good). The conditions: of a card's first row or its only one (``is_first_row``), or of any day of purchases."""
    enrolled, day, lead = F.col("enrolled"), F.col("date"), F.col("is_first_row")
    if name == "membersarchived":
        lapsed = F.when(enrolled.isNotNull(), F.greatest(enrolled, first_after(day, cfg.archive_months)))
        return [(lead, enrolled, F.col("first_day")), (day.isNotNull(), lapsed, F.col("next_day"))]
    if name == "dormantcustomers":
        spent = day.isNotNull() & F.col("spent_in_focus") & F.col("holds_points")
        return [(spent, first_after(day, cfg.dormant_months), F.col("next_focus_spend_day"))]
    return [(lead, F.col("low_points_since"), F.lit(None).cast("date"))]


def _steps(name: str, cfg: Config) -> list[Column]:
    """The days on which a row's spells begin (1) and end (-1), null where there are none."""
    steps = []
    for condition, entry, exit_ in _spells(name, cfg):
        holds = condition & (exit_.isNull() | (entry < exit_))
        for day, step in ((entry, 1), (exit_, -1)):
            on = F.when(holds & entry.isNotNull(), clamp_entry(day, cfg.spine_start))
            steps.append(F.struct(F.lit(name).alias("kind"), on.alias("on"), F.lit(step).alias("step")))
    return steps


def _day_measure(name: str, in_parts: bool) -> list[Column]:
    """Aggregates over the splits of a day. A card has one row per day that counts, so rows are cards."""
    is_purchase = F.col("kind") == _PURCHASE

    def cards(condition):
        return F.sum(F.when(is_purchase & condition, F.col("cards")))

    def total(condition):
        if in_parts:
            return exact.group_sums(name, "amount", f"kind = '{_PURCHASE}' AND {condition}")
        return F.sum(F.when(is_purchase & F.expr(condition), F.col("amount"))).cast("double")

    measures = {
        "newcustomercount": lambda: cards(F.col("is_first")),
        "repeatcustomercount": lambda: cards(~F.col("is_first")),
        "totalcustomertransactions": lambda: cards(F.lit(True)),
        "newcustomersales": lambda: total("is_first"),
        "repeatcustomersales": lambda: total("NOT is_first"),
        "transactedcustomersales": lambda: total("TRUE"),
        "birthdaycustomercount": lambda: cards(F.col("near_birthday")),
        "birthdaycustomersales": lambda: total("near_birthday"),
        "anncustomercount": lambda: cards(F.col("near_anniversary")),
        "annvcustomersales": lambda: total("near_anniversary"),
    }
    if name in measures:
        measure = measures[name]()
        return measure if isinstance(measure, list) else [measure.alias(name)]
    if name in STATE + ON_MEMBER_DAYS:
        return [F.sum(F.when(F.col("kind") == name, F.col("cards"))).alias(name)]
    return [F.sum(F.when(is_purchase, F.col(name))).alias(name)]


def activity_by_day(tables: Tables, cfg: Config, measures: Iterable[str] = ALL) -> DataFrame:
    """One row per day with the asked measures, ``is_focus_day`` and, with measures of member days, ``is_enrollment_day``.

    State measures hold the number of cards that enter the state on the day less those that leave it, with days before
    the calendar moved to its first day. Measures of yearly events hold the number of cards that count on the day and on
    every later one of the same month and day. Days before the calendar are still in the result.
    """
    asked = list(measures)
    if tables.card_days is not None:
        in_parts, days = cfg.exact_amounts, tables.card_days
    else:
        in_parts = cfg.exact_amounts and bool(set(asked) & _AMOUNTS)
        days = (card_days_in_parts if in_parts else card_days)(tables.transactions, cfg)

    def cards(with_days: bool) -> DataFrame:
        if tables.cards is not None:
            return tables.cards if with_days else tables.cards.where("card_no IS NOT NULL").drop("member_days")
        return (member_cards_with_days if with_days else member_cards)(tables.members, cfg)

    return by_day(contributions(days, cards, cfg, asked, in_parts), asked, in_parts)


def contributions(
    days: DataFrame, cards: Callable[[bool], DataFrame], cfg: Config, asked: list[str], in_parts: bool
) -> DataFrame:
    """What the cards add to each day, by split: numbers that add up over any sets of cards.

    ``cards`` gives the member cards, with their member days or without.
    """
    states = [name for name in STATE if name in asked]
    splits = [name for name, users in _SPLITS.items() if users & set(asked)]
    leaving = cfg.leaving and bool(states)
    rows = with_history(days, following=leaving)
    # of a card and day only one row counts; rows of cards without purchases have no bin
    counts = F.coalesce(F.col("amount_bin"), F.lit(0)) == 0 if in_parts else F.lit(True)
    bins, sums = (["amount_bin"], exact.summed("amount")) if in_parts else ([], [F.sum("amount").alias("amount")])
    member_days = bool(set(asked) & set(ON_MEMBER_DAYS))
    if set(asked) & set(MEMBER + STATE) or member_days:
        # Members without purchases matter to the measures of states and of member days only.
        how = "full" if states or member_days else "left"
        rows = rows.join(cards(member_days), "card_no", how)

    # Every row speaks for its own day; one row per card also speaks for the card's entry days.
    own_kind = F.when(F.col("card_no").isNull(), _NO_CARD).otherwise(_PURCHASE)
    own = F.struct(own_kind.alias("kind"), F.col("date").alias("on"))
    entries = [
        F.struct(F.lit(name).alias("kind"), clamp_entry(_entry_day(name, cfg), cfg.spine_start).alias("on"))
        for name in states if not cfg.leaving
    ]
    speaks_for_card = F.col("date").isNull() | ((F.col("date") == F.col("first_day")) & counts)
    said = F.array(own, *entries)
    if member_days:
        said = F.concat(said, F.coalesce(F.col("member_days"), F.array().cast("array<struct<kind:string,on:date>>")))
    spoken = F.when(speaks_for_card, said).otherwise(F.array(own)) if entries or member_days else F.array(own)
    if leaving:
        # any day of purchases may begin and end a spell, so every row that counts speaks for them
        stepped = F.transform(spoken, lambda s: F.struct(s.kind.alias("kind"), s.on.alias("on"), F.lit(1).alias("step")))
        steps = F.array(*[step for name in states for step in _steps(name, cfg)])
        spoken = F.concat(stepped, F.when(F.col("card_no").isNotNull() & counts, steps).otherwise(F.slice(steps, 1, 0)))
        rows = rows.withColumn("is_first_row", speaks_for_card)
    rows = rows.withColumns({name: _split(name, cfg) for name in splits}).select("*", F.inline(spoken))

    # One amount and one count per split, instead of a sum per measure over all rows: a day has at
    # most a handful of splits, and adding up decimals is the dearest part of the pass.
    is_member = F.col("enrolled").isNotNull()
    flags = {
        "crosschannelbuyers": lambda: F.sum(
            F.when((F.col("date") == F.col("first_focus_day")) & counts, first_focus_reasons(cfg)).otherwise(0)
        ),
        "diamondenthusiasts": lambda: F.count_if(F.col("keyword_in_focus") & is_member),
        "activecustomers": lambda: F.count_if(F.col("spent_in_program") & (F.col("date") >= F.col("enrolled"))),
    }
    is_card = counts & ((F.col("kind") != ENROLLED) | F.col("card_no").isNotNull())
    cards_on = F.sum(F.when(is_card, F.col("step")).otherwise(0)) if leaving else F.count_if(is_card)
    return (
        rows.filter(F.col("on").isNotNull())
        .groupBy("on", "kind", *splits, *bins)
        .agg(
            cards_on.alias("cards"),
            *sums,
            F.count_if("in_focus").alias("focus_rows"),
            *[column().alias(name) for name, column in flags.items() if name in asked],
        )
    )


def by_day(per_split: DataFrame, asked: list[str], in_parts: bool) -> DataFrame:
    """``contributions`` added up per day; see ``activity_by_day``."""
    member_days = bool(set(asked) & set(ON_MEMBER_DAYS))
    is_focus_day = F.bool_or((F.col("focus_rows") > 0) & F.col("kind").isin(_PURCHASE, _NO_CARD))
    per_day = per_split.groupBy(F.col("on").alias("date")).agg(
        *[column for name in asked for column in _day_measure(name, in_parts)], is_focus_day.alias(FOCUS_DAY),
        *([F.bool_or(F.col("kind") == ENROLLED).alias(ENROLLMENT_DAY)] if member_days else []),
    )
    amounts = [name for name in asked if name in _AMOUNTS]
    if in_parts and amounts:
        per_day = exact.finish(per_day, *amounts)
    return per_day.fillna(0, subset=[name for name in asked if name not in _AMOUNTS])
