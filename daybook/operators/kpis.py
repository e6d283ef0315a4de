"""One function per measure: ``f(tables, cfg) -> (date, <measure>)``, at most one row per date.

Measures of a day's events have rows only for days with something to report. Measures of a state
(``members_archived``, ``dormant_customers``, ``low_point_balance_customers``) and of the calendar
(birthdays and anniversaries per day, base) have one row per day of the calendar.

Each measure is planned on its own: it filters first and shuffles as little as it can, mostly one
row per card, or per card and day, combined on the map side. ``plans.daily`` computes all of them in
one pass instead. Member cards are made unique before a join, so a card that holds many member rows
never meets many purchases in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook.config import Config
from daybook.functions import exact
from daybook.functions.dates import first_after
from daybook.operators.activity import ENROLLMENT_DAY, FOCUS_DAY, activity_by_day, first_focus_reasons
from daybook.operators.base import base_on
from daybook.operators.campaigns import LABELS, campaigns_by_day
from daybook.operators.cards import ENROLLED
from daybook.operators.members import enrolled_by_day, events_on_calendar
from daybook.operators.population import clamp_entry, population_by_day, running_total
from daybook.operators.spine import calendarise, date_spine, spine_bounds
from daybook.sources.tables import Tables


def _spine(tables: Tables, cfg: Config) -> DataFrame:
    return date_spine(spine_bounds(tables, cfg))


def _purchases(tables: Tables) -> DataFrame:
    """Purchases with a card."""
    return tables.transactions.filter(F.col("card_no").isNotNull()).withColumnRenamed("invoice_date", "date")


def _in_focus(cfg: Config) -> Column:
    return F.col("channel") == cfg.focus_channel


def _enrolled_cards(tables: Tables) -> DataFrame:
    """One row per member card with its first enrollment date."""
    members = tables.members.filter(F.col("card_no").isNotNull())
    return members.groupBy("card_no").agg(F.min("enrollment_date").alias("enrolled"))


def _count_rows(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("date").agg(F.count("*").alias(name))


def _count(tables: Tables, cfg: Config, name: str) -> DataFrame:
    return activity_by_day(tables, cfg, [name]).select("date", name).filter(F.col(name) > 0)


def _sum(tables: Tables, cfg: Config, name: str) -> DataFrame:
    return activity_by_day(tables, cfg, [name]).select("date", name).filter(F.col(name).isNotNull())


def _state(entries: DataFrame, tables: Tables, cfg: Config, name: str) -> DataFrame:
    return population_by_day(entries, _spine(tables, cfg), cfg.spine_start, name)


def _state_per_card(
    tables: Tables, cfg: Config, bought: dict[str, Column], held: dict[str, Column], entry: Column, name: str
) -> DataFrame:
    """A state measure with one scan of the transactions: ``entry`` from one row per card, which has the
    aggregates ``bought`` of its transactions and ``held`` of its member rows, and ``enrolled``.

    The same rows say where the calendar ends. Rows without a card are one group, combined on the map
    side; they matter for the calendar only.
    """
    last_focus = F.max(F.when(_in_focus(cfg), F.col("invoice_date"))).alias("last_focus")
    per_card = tables.transactions.groupBy("card_no").agg(last_focus, *[c.alias(n) for n, c in bought.items()])
    members = tables.members.groupBy("card_no").agg(
        F.min("enrollment_date").alias("enrolled"),
        F.max("enrollment_date").alias("last_enrolled"),
        *[c.alias(n) for n, c in held.items()],
    )
    cards = per_card.join(members, "card_no", "full")
    entered = F.when(F.col("card_no").isNotNull(), clamp_entry(entry, cfg.spine_start))
    seen = F.greatest("last_focus", "last_enrolled")
    days = cards.select(F.inline(F.array(
        F.struct(entered.alias("date"), F.lit(1).alias("cards"), F.lit(False).alias("is_end")),
        F.struct(seen.alias("date"), F.lit(0).alias("cards"), F.lit(True).alias("is_end")),
    ))).filter(F.col("date").isNotNull())
    start = tables.members.sparkSession.range(1).select(
        F.lit(cfg.spine_start).alias("date"), F.lit(0).alias("cards"), F.lit(False).alias("is_end")
    )
    per_day = days.union(start).groupBy("date").agg(F.sum("cards").alias(name), F.bool_or("is_end").alias("is_end"))
    calendar = calendarise(per_day, cfg.spine_start, F.col("is_end"))
    return calendar.select("date", running_total(name).alias(name))


def _state_so_far(tables: Tables, cfg: Config, name: str) -> DataFrame:
    """A state that cards leave when they buy, from the pass over card-days; enrollments say where the calendar ends."""
    days = activity_by_day(tables, cfg, [name, ENROLLED]).select("date", name, (F.col(FOCUS_DAY) | F.col(ENROLLMENT_DAY)).alias("is_end"))
    start = tables.members.sparkSession.range(1).select(
        F.lit(cfg.spine_start).alias("date"), F.lit(0).cast("long").alias(name), F.lit(False).alias("is_end")
    )
    per_day = days.union(start).groupBy("date").agg(F.sum(name).alias(name), F.bool_or("is_end").alias("is_end"))
    return calendarise(per_day, cfg.spine_start, F.col("is_end")).select("date", running_total(name).alias(name))


def new_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Cards whose first purchase ever is on the day."""
    rows = _purchases(tables) if tables.card_days is None else tables.card_days.where("card_no IS NOT NULL")
    first_days = rows.groupBy("card_no").agg(F.min("date").alias("date"))
    return _count_rows(first_days, "newcustomercount")


def repeat_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Cards that buy on the day and bought on an earlier day."""
    return _count(tables, cfg, "repeatcustomercount")


def total_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Cards that buy on the day."""
    bought = _purchases(tables).select("card_no", "date").distinct()
    return _count_rows(bought, "totalcustomertransactions")


def new_customer_sales(tables: Tables, cfg: Config) -> DataFrame:
    """Amount on the cards' first purchase day."""
    return _sum(tables, cfg, "newcustomersales")


def repeat_customer_sales(tables: Tables, cfg: Config) -> DataFrame:
    """Amount on later days."""
    return _sum(tables, cfg, "repeatcustomersales")


def transacted_sales(tables: Tables, cfg: Config) -> DataFrame:
    """All amount of the day with a card."""
    name = "transactedcustomersales"
    amounts = _purchases(tables).filter(F.col("amount").isNotNull()).select("date", F.col("amount").alias(name))
    if cfg.exact_amounts:
        return exact.sum_by(amounts, ["date"], name)
    return amounts.groupBy("date").agg(F.sum(name).cast("double").alias(name))


def birthday_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards that buy within the window around a birthday."""
    return _count(tables, cfg, "birthdaycustomercount")


def birthday_sales(tables: Tables, cfg: Config) -> DataFrame:
    """Amount of the purchases of ``birthday_customers``, each counted once."""
    return _sum(tables, cfg, "birthdaycustomersales")


def anniversary_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards that buy within the window around a wedding anniversary."""
    return _count(tables, cfg, "anncustomercount")


def anniversary_sales(tables: Tables, cfg: Config) -> DataFrame:
    """Amount of the purchases of ``anniversary_customers``, each counted once."""
    return _sum(tables, cfg, "annvcustomersales")


def birthdays_per_day(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards with their birthday on the day, enrolled in that month or earlier."""
    return events_on_calendar(_spine(tables, cfg), tables.members, {"dob": "customerbirthdaysperday"}, cfg)


def anniversaries_per_day(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards with their wedding anniversary on the day, enrolled in that month or earlier."""
    return events_on_calendar(
        _spine(tables, cfg), tables.members, {"anniversary": "customeranniversariesperday"}, cfg
    )


def enrolled_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards enrolled on the day."""
    return enrolled_by_day(tables.members).filter(F.col("enrolledcustomercount") > 0)


def members_archived(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards enrolled by the day that never bought, or whose last purchase of all is more
    than ``archive_months`` before the day. By the purchases ``so_far``, a card leaves with its next purchase."""
    if cfg.leaving:
        return _state_so_far(tables, cfg, "membersarchived")
    lapsed = first_after(F.col("last_day"), cfg.archive_months)  # null without any purchase
    entry = F.when(F.col("enrolled").isNotNull(), F.greatest("enrolled", lapsed))
    return _state_per_card(tables, cfg, {"last_day": F.max("invoice_date")}, {}, entry, "membersarchived")


def cross_channel_buyers(tables: Tables, cfg: Config) -> DataFrame:
    """Cards whose first focus-channel purchase is on the day, and that bought in another channel
    or enrolled before it."""
    name, day = "crosschannelbuyers", F.col("date")
    buyers = (
        _purchases(tables)
        .groupBy("card_no")
        .agg(
            F.min(F.when(_in_focus(cfg), day)).alias("first_focus_day"),
            F.min(F.when(F.col("channel") != cfg.focus_channel, day)).alias("first_elsewhere_day"),
        )
        .filter(F.col("first_focus_day").isNotNull())
        .join(_enrolled_cards(tables), "card_no", "left")
    )
    per_day = buyers.groupBy(F.col("first_focus_day").alias("date")).agg(F.sum(first_focus_reasons(cfg)).alias(name))
    return per_day.filter(F.col(name) > 0)


def keyword_buyers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards that buy a keyword category in the focus channel."""
    is_keyword = F.col("category").contains(cfg.category_keyword)
    bought = _purchases(tables).filter(_in_focus(cfg) & is_keyword).select("card_no", "date").distinct()
    member_cards = tables.members.select("card_no").distinct()
    return _count_rows(bought.join(member_cards, "card_no", "left_semi"), "diamondenthusiasts")


def dormant_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards above the point threshold whose last focus-channel purchase with an amount is
    more than ``dormant_months`` before the day. By the purchases ``so_far``, a card leaves with its next such purchase."""
    if cfg.leaving:
        return _state_so_far(tables, cfg, "dormantcustomers")
    spent = F.max(F.when(_in_focus(cfg) & F.col("is_nonzero"), F.col("invoice_date")))
    holds = F.bool_or(F.coalesce(F.col("point_balance") > cfg.point_threshold, F.lit(False)))
    entry = F.when(F.col("holds"), first_after(F.col("last_day"), cfg.dormant_months))
    return _state_per_card(tables, cfg, {"last_day": spent}, {"holds": holds}, entry, "dormantcustomers")


def low_point_balance_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards below the point threshold, enrolled by the day."""
    low = tables.members.filter(F.col("point_balance") < cfg.point_threshold)
    entries = low.select("card_no", F.col("enrollment_date").alias("entry"))
    return _state(entries, tables, cfg, "lowpointbalancecustomers")


def active_customers(tables: Tables, cfg: Config) -> DataFrame:
    """Member cards with a purchase with an amount in a program channel, on or after enrollment."""
    if tables.card_days is not None:
        return _count(tables, cfg, "activecustomers")
    in_program = F.col("channel").isin(*cfg.program_channels)
    bought = _purchases(tables).filter(in_program & F.col("is_nonzero")).select("card_no", "date").distinct()
    active = bought.join(_enrolled_cards(tables), "card_no").filter(F.col("date") >= F.col("enrolled"))
    return _count_rows(active, "activecustomers")


def campaigns_deployed(tables: Tables, cfg: Config) -> DataFrame:
    """Campaigns with their deployment date on the day."""
    counted = campaigns_by_day(tables.campaigns, cfg, labels=()).select("date", "campaignsdeployed")
    return counted.filter(F.col("campaignsdeployed") > 0)


def targeted_count(tables: Tables, cfg: Config) -> DataFrame:
    """Customers targeted by the day's campaigns."""
    return campaigns_by_day(tables.campaigns, cfg, labels=()).select("date", "targetedcount")


def campaign_buyers(tables: Tables, cfg: Config) -> DataFrame:
    """Buyers of the day's campaigns."""
    return campaigns_by_day(tables.campaigns, cfg, labels=()).select("date", "buyers")


def incremental_revenue(tables: Tables, cfg: Config) -> DataFrame:
    """Incremental revenue of the day's campaigns."""
    return campaigns_by_day(tables.campaigns, cfg, labels=()).select("date", "incrementalrev")


def campaign_details(tables: Tables, cfg: Config) -> DataFrame:
    """Sales, mean conversion and label sets of the day's campaigns."""
    return campaigns_by_day(tables.campaigns, cfg).select("date", "sale_value_1", "conversion_1", *LABELS)


def previous_month_base(tables: Tables, cfg: Config) -> DataFrame:
    """The configured base count."""
    return _spine(tables, cfg).select("date", base_on(F.col("date"), cfg).alias("previousmonthbase"))
