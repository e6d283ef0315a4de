"""States that cards enter and leave, against a count per card and day."""

import datetime as dt
import random
from dataclasses import replace

import pytest

from daybook import Config, daily
from daybook.operators import kpis
from daybook.operators.population import population_in_spells
from tests import small
from tests.test_equivalence import CONFIG, random_rows
from tests.test_plans import plan_of

FIRST = dt.date(2024, 1, 1)
DAYS = [FIRST + dt.timedelta(days=i) for i in range(60)]
SO_FAR = replace(CONFIG, state_purchases="so_far")


def test_spells_equal_a_count_per_day(spark):
    """Overlaps, touching and empty spells, spells before the calendar and without end; one card has a third of all."""
    rng = random.Random(5)

    def day():
        return None if rng.random() < 0.1 else FIRST + dt.timedelta(days=rng.randrange(-20, 70))

    spells = [("hot" if rng.random() < 1 / 3 else rng.choice([None, *"abcdef"]), day(), day()) for _ in range(300)]
    frame = spark.createDataFrame(spells, "card_no string, entry date, exit date").repartition(7)
    spine = spark.createDataFrame([(d,) for d in DAYS], "date date")
    got = {r["date"]: r["cards"] for r in population_in_spells(frame, spine, FIRST, "cards").collect()}
    assert got == {d: len({c for c, a, b in spells if c and a and a <= d and (b is None or d < b)}) for d in DAYS}
    assert population_in_spells(frame.limit(0), spine, FIRST, "cards").filter("cards <> 0").count() == 0


def test_sweep_shuffles_by_card_once_after_the_events_are_combined(spark):
    frame = spark.createDataFrame([("a", FIRST, None)], "card_no string, entry date, exit date")
    spine = spark.createDataFrame([(d,) for d in DAYS], "date date")
    plan = plan_of(population_in_spells(frame, spine, FIRST, "cards"), "simple")
    assert plan.count("Exchange hashpartitioning(card_no") <= 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def months_before(day, months):
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = (dt.date(year + month // 11, month % 11 + 1 if month == 11 else month + 2, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last))


@pytest.mark.parametrize("seed", [11, 4])
def test_states_so_far_equal_brute_force(spark, seed):
    tables = small.tables(spark, SO_FAR, **random_rows(seed))
    members, buys = tables.members.collect(), tables.transactions.collect()
    enrolled, holds = {}, set()
    for m in members:
        if m["card_no"] is not None:
            enrolled[m["card_no"]] = min(enrolled.get(m["card_no"], m["enrollment_date"]), m["enrollment_date"])
            if m["point_balance"] is not None and m["point_balance"] > 50:
                holds.add(m["card_no"])
    days, spent = {}, {}
    for b in buys:
        days.setdefault(b["card_no"], set()).add(b["invoice_date"])
        if b["channel"] == "store" and b["is_nonzero"]:
            spent.setdefault(b["card_no"], set()).add(b["invoice_date"])
    frame = {r["date"]: r for r in daily(tables, SO_FAR).collect()}
    archived = small.by_day(kpis.members_archived(tables, SO_FAR), "membersarchived")
    dormant = small.by_day(kpis.dormant_customers(tables, SO_FAR), "dormantcustomers")
    assert set(frame) == set(archived) == set(dormant)

    def away(card, of, day, months, never):
        last = max((d for d in of.get(card, ()) if d <= day), default=None)
        return never if last is None else last < months_before(day, months)

    fell = False
    for day in frame:
        expected = sum(e <= day and away(c, days, day, 36, True) for c, e in enrolled.items())
        assert frame[day]["membersarchived"] == archived[day] == expected, day
        expected = sum(away(c, spent, day, 6, False) for c in holds)
        assert frame[day]["dormantcustomers"] == dormant[day] == expected, day
        fell |= dormant.get(day - dt.timedelta(days=1), 0) > dormant[day]
    assert fell  # cards do leave


def test_setting_is_checked():
    settings = dict(focus_channel="store", program_channels=("store",), category_keyword="x")
    with pytest.raises(ValueError):
        Config(**settings, state_purchases="later")
    with pytest.raises(ValueError):
        Config(**settings, state_purchases="so_far", semantics="reference")
