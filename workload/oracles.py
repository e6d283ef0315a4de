"""Independent DuckDB SQL for the registered queries.

Each measure is written the plain way: per day, with joins and distinct counts over whole tables,
and with none of the reductions the Spark side uses.
"""

from __future__ import annotations

import re

from workload.inputs import CAMPAIGNS, CONFIG, MEMBERS, TRANSACTIONS

_NAMES = {name: name for name in ("customer", "orders", "lineitem", "part", "events")}
PROGRAM = ", ".join(f"'{channel}'" for channel in CONFIG.program_channels)
FOCUS = f"'{CONFIG.focus_channel}'"
START = f"DATE '{CONFIG.spine_start}'"

RAW_MEMBERS = MEMBERS.format(**_NAMES)
RAW_TRANSACTIONS = TRANSACTIONS.format(**_NAMES)
RAW_CAMPAIGNS = CAMPAIGNS.format(**_NAMES)


def day(text: str) -> str:
    """Date of an ISO text with nothing or a time behind it."""
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T].*)?') "
        f"THEN TRY_CAST(substr({text}, 1, 10) AS DATE) END"
    )


def clean_id(text: str, literal: bool) -> str:
    if literal:
        return f"trim(regexp_replace({text}, '\\.0$', ''))"
    stripped = f"trim(regexp_replace(trim({text}), '\\.0$', ''))"
    return f"CASE WHEN {stripped} NOT IN ('', 'None', 'nan', 'NaT') THEN {stripped} END"


def _lenient_int(text: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({text}), '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1) AS INT)"


def deployed(text: str, literal: bool) -> str:
    day_first = "^[0-9]{2}-[0-9]{2}-[0-9]{4}" + ("$" if literal else "")
    turned = f"concat(substr({text}, 7, 4), '-', substr({text}, 4, 2), '-', substr({text}, 1, 2))"
    return (
        f"CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN TRY_CAST(substr({text}, 1, 10) AS DATE) "
        f"WHEN regexp_matches({text}, '{day_first}') THEN TRY_CAST({turned} AS DATE) END"
    )


def whole(text: str, literal: bool) -> str:
    kind = "INT" if literal else "DOUBLE"
    return f"CASE WHEN regexp_full_match(trim({text}), '[0-9]+') THEN TRY_CAST(trim({text}) AS {kind}) ELSE 0 END"


def number(text: str) -> str:
    """Any plain number, as a double."""
    plain = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match(trim({text}), '{plain}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def figure(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '-?[0-9]+(\\.[0-9]+)?') "
        f"THEN TRY_CAST(trim({text}) AS DOUBLE) ELSE 0 END"
    )


def _clean(literal: bool) -> dict[str, str]:
    """The CTEs all measures start from: m, t, k and the spine."""
    amount = "TRY_CAST(eligible_amt AS DOUBLE)" if literal else number("eligible_amt")
    nonzero = f"{_lenient_int('eligible_amt')} <> 0" if literal else f"{amount} <> 0"
    points = _lenient_int("point_balance") if literal else number("point_balance")
    return {
        "m": f"""
            SELECT {clean_id('card_no', literal)} AS card, {day('enrollment_date')} AS enrolled,
                   {day('dob')} AS dob, {day('anniversary')} AS anniversary, {points} AS points
            FROM ({RAW_MEMBERS}) AS raw_members
            WHERE lower(enrollment_channel_code) IN ({PROGRAM}) AND {day('enrollment_date')} IS NOT NULL""",
        "every_t": f"""
            SELECT {clean_id('card_no', literal)} AS card, {day('invoice_date')} AS day, lower(channel) AS channel,
                   lower(category) AS category, {amount} AS amount, {nonzero} AS nonzero
            FROM ({RAW_TRANSACTIONS}) AS raw_transactions WHERE {day('invoice_date')} IS NOT NULL""",
        "t": "SELECT * FROM every_t WHERE card IS NOT NULL",
        "k": f"""
            SELECT {deployed('deployment_date', literal)} AS date, {day('deployment_date')} AS whole_text_day,
                   deployment_date, {whole('target_count', literal)} AS target_count, {whole('buyers', literal)} AS buyers,
                   {figure('incremental_rev')} AS incremental_rev, {figure('sale_value_1')} AS sale_value_1,
                   {figure('conversion_1')} AS conversion_1, channel, brand, region
            FROM ({RAW_CAMPAIGNS}) AS raw_campaigns WHERE {deployed('deployment_date', literal)} IS NOT NULL""",
        "spine": f"""
            SELECT CAST(unnest(generate_series({START}, (SELECT max(day) FROM
                     (SELECT enrolled AS day FROM m UNION ALL SELECT day FROM every_t WHERE channel = {FOCUS})),
                     INTERVAL 1 DAY)) AS DATE) AS date""",
    }


def _near(event: str) -> str:
    in_year = (
        f"make_date(year(day), month({event}), "
        f"CASE WHEN month({event}) = 2 AND day({event}) = 29 THEN 28 ELSE day({event}) END)"
    )
    return f"{event} IS NOT NULL AND abs(date_diff('day', {in_year}, day)) <= {CONFIG.event_window_days}"


def _event_purchases(event: str) -> str:
    return f"SELECT * FROM t WHERE EXISTS (SELECT 1 FROM m WHERE m.card = t.card AND {_near(event)})"


def _events_per_day(event: str, name: str, literal: bool) -> str:
    def month(day):
        return f"concat(year({day}), '-', month({day}))" if literal else f"date_trunc('month', {day})"

    return f"""
        SELECT date, CAST(count(DISTINCT card) AS BIGINT) AS {name}
        FROM spine LEFT JOIN m ON {month('enrolled')} <= {month('date')}
          AND month({event}) = month(date) AND day({event}) = day(date)
        GROUP BY date"""


_FIRST = "(SELECT card, min(day) AS first_day FROM t GROUP BY card)"
_FIRST_FOCUS = f"(SELECT card, min(day) AS first_focus FROM t WHERE channel = {FOCUS} GROUP BY card)"
_SUM = "CAST(sum(amount) AS DOUBLE)"


def _overrides() -> str:
    arms = " ".join(f"WHEN DATE '{day}' THEN {value}" for day, value in CONFIG.base_overrides.items())
    return f"CASE date {arms} ELSE 0 END"


def _labels(name: str, literal: bool) -> str:
    joined = f"string_agg(DISTINCT {name}, ', ' ORDER BY {name})"
    return f"coalesce({joined}, '') AS {name}" if literal else f"{joined} AS {name}"


def _cross_channel(literal: bool) -> str:
    elsewhere = f"SELECT card FROM t JOIN {_FIRST_FOCUS} USING (card) WHERE channel <> {FOCUS} AND day < first_focus"
    before = f"SELECT card FROM m JOIN {_FIRST_FOCUS} USING (card) WHERE enrolled < first_focus"
    if literal:
        reasons = f"SELECT DISTINCT card FROM ({elsewhere}) UNION ALL SELECT DISTINCT card FROM ({before})"
    else:
        reasons = f"{elsewhere} UNION {before}"
    return f"""
        SELECT first_focus AS date, CAST(count(card) AS BIGINT) AS crosschannelbuyers
        FROM {_FIRST_FOCUS} JOIN ({reasons}) USING (card) GROUP BY first_focus"""


def _states_so_far() -> dict[str, str]:
    """The states that follow the purchases up to the day: cards that qualify by then, but for those that bought lately."""

    def state(name, qualified, bought, months):
        return f"""
            SELECT date, CAST(coalesce(cards, 0) - coalesce(lately, 0) AS BIGINT) AS {name} FROM spine
            LEFT JOIN (SELECT date, count(DISTINCT card) AS cards FROM spine JOIN ({qualified}) ON since <= date GROUP BY date) USING (date)
            LEFT JOIN (SELECT date, count(DISTINCT card) AS lately FROM spine JOIN ({bought})
                       ON since <= date AND day BETWEEN date - INTERVAL {months} MONTH AND date GROUP BY date) USING (date)"""

    enrolled = "SELECT card, min(enrolled) AS since FROM m WHERE card IS NOT NULL GROUP BY card"
    spent = (
        f"SELECT DISTINCT card, day, day AS since FROM t WHERE nonzero AND channel = {FOCUS} "
        f"AND card IN (SELECT card FROM m WHERE points > {CONFIG.point_threshold})"
    )
    return {
        "membersarchived": state(
            "membersarchived", enrolled, f"SELECT DISTINCT card, day, since FROM t JOIN ({enrolled}) USING (card)", CONFIG.archive_months
        ),
        "dormantcustomers": state("dormantcustomers", spent, spent, CONFIG.dormant_months),
    }


def _measures(literal: bool) -> dict[str, str]:
    """Name of the measure -> SELECT of (date, measure ...) over the CTEs of ``_clean``."""

    def cards(name, source, where="TRUE", day="day"):
        return (
            f"SELECT {day} AS date, CAST(count(DISTINCT card) AS BIGINT) AS {name} FROM {source} "
            f"WHERE {where} GROUP BY {day} HAVING count(DISTINCT card) > 0"
        )

    def amounts(name, source, where="TRUE"):
        return (
            f"SELECT day AS date, {_SUM} AS {name} FROM {source} WHERE amount IS NOT NULL AND {where} GROUP BY day"
        )

    def state(name, source, where):
        return f"""
            SELECT date, CAST(count(DISTINCT card) AS BIGINT) AS {name}
            FROM spine LEFT JOIN {source} ON {where} GROUP BY date"""

    # The literal job loses the day of the purchases near an event.
    events = "FALSE" if literal else "TRUE"
    member_cards = "card IN (SELECT card FROM m WHERE card IS NOT NULL)"
    last = "(SELECT m.*, last_day FROM m LEFT JOIN (SELECT card, max(day) AS last_day FROM t GROUP BY card) USING (card))"
    last_spend = (
        f"(SELECT m.*, last_day FROM m JOIN (SELECT card, max(day) AS last_day FROM t "
        f"WHERE nonzero AND channel = {FOCUS} GROUP BY card) USING (card) WHERE points > {CONFIG.point_threshold})"
    )
    count = "BIGINT" if literal else "DOUBLE"
    counted = "whole_text_day IS NOT NULL OR NOT regexp_matches(deployment_date, '^[0-9]{4}-')" if literal else "TRUE"
    return {
        "newcustomercount": cards("newcustomercount", f"t JOIN {_FIRST} USING (card)", "day = first_day"),
        "repeatcustomercount": cards("repeatcustomercount", f"t JOIN {_FIRST} USING (card)", "day > first_day"),
        "totalcustomertransactions": cards("totalcustomertransactions", "t"),
        "newcustomersales": amounts("newcustomersales", f"t JOIN {_FIRST} USING (card)", "day = first_day"),
        "repeatcustomersales": amounts("repeatcustomersales", f"t JOIN {_FIRST} USING (card)", "day > first_day"),
        "transactedcustomersales": amounts("transactedcustomersales", "t"),
        "birthdaycustomercount": cards("birthdaycustomercount", f"({_event_purchases('dob')})", events),
        "birthdaycustomersales": amounts("birthdaycustomersales", f"({_event_purchases('dob')})", events),
        "anncustomercount": cards("anncustomercount", f"({_event_purchases('anniversary')})", events),
        "annvcustomersales": amounts("annvcustomersales", f"({_event_purchases('anniversary')})", events),
        "customerbirthdaysperday": _events_per_day("dob", "customerbirthdaysperday", literal),
        "customeranniversariesperday": _events_per_day("anniversary", "customeranniversariesperday", literal),
        "enrolledcustomercount": cards("enrolledcustomercount", "m", day="enrolled"),
        "membersarchived": state(
            "membersarchived", last,
            f"enrolled <= date AND (last_day IS NULL OR last_day < date - INTERVAL {CONFIG.archive_months} MONTH)",
        ),
        "crosschannelbuyers": _cross_channel(literal),
        "diamondenthusiasts": cards(
            "diamondenthusiasts", "t",
            f"channel = {FOCUS} AND contains(category, '{CONFIG.category_keyword}') AND {member_cards}",
        ),
        "dormantcustomers": state(
            "dormantcustomers", last_spend, f"last_day < date - INTERVAL {CONFIG.dormant_months} MONTH"
        ),
        "lowpointbalancecustomers": state(
            "lowpointbalancecustomers", f"(SELECT * FROM m WHERE points < {CONFIG.point_threshold})", "enrolled <= date"
        ),
        "activecustomers": cards(
            "activecustomers", "t JOIN (SELECT card, enrolled FROM m) USING (card)",
            f"nonzero AND channel IN ({PROGRAM}) AND day >= enrolled",
        ),
        "campaignsdeployed": f"""
            SELECT date, CAST(count(*) AS BIGINT) AS campaignsdeployed FROM k WHERE {counted} GROUP BY date""",
        "targetedcount": f"SELECT date, CAST(sum(target_count) AS {count}) AS targetedcount FROM k GROUP BY date",
        "buyers": f"SELECT date, CAST(sum(buyers) AS {count}) AS buyers FROM k GROUP BY date",
        "incrementalrev": "SELECT date, CAST(sum(incremental_rev) AS DOUBLE) AS incrementalrev FROM k GROUP BY date",
        "details": f"""
            SELECT date, CAST(sum(sale_value_1) AS DOUBLE) AS sale_value_1,
                   CAST(sum(conversion_1) AS DOUBLE) / count(conversion_1) AS conversion_1,
                   {_labels('channel', literal)}, {_labels('brand', literal)}, {_labels('region', literal)}
            FROM k GROUP BY date""",
        "previousmonthbase": f"SELECT date, CAST({_overrides()} AS INT) AS previousmonthbase FROM spine",
    }


def _with(ctes: dict[str, str], select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{select}"


def conformed(ddl: str, table: str, names: dict[str, str]) -> str:
    """All declared columns: the given ones cast, the others null."""
    kinds = {"STRING": "VARCHAR", "TIMESTAMP_NTZ": "TIMESTAMP"}
    declared = re.findall(r"(\w+) ([A-Z_]+(?:\(\d+,\d+\))?)", ddl)
    columns = [f'CAST({names.get(name, "NULL")} AS {kinds.get(kind, kind)}) AS "{name}"' for name, kind in declared if name != "NOT"]
    return f"SELECT {', '.join(columns)} FROM {table}"


def with_clean(select: str) -> str:
    """A SELECT over the cleaned tables m, t, every_t, k and the spine."""
    return _with(_clean(False), select)


def rounded(select: str, names: list[str], digits: dict[str, int]) -> str:
    """Doubles rounded like on the Spark side, all other columns as they are."""
    columns = [f"round({name}, {digits[name]}) AS {name}" if name in digits else name for name in names]
    return f"SELECT {', '.join(columns)} FROM ({select}) AS exact"


def measure(name: str, names: list[str], digits: dict[str, int], so_far: bool = False) -> str:
    measures = _measures(False) | (_states_so_far() if so_far else {})
    return with_clean(rounded(measures[name], ["date", *names], digits))


def daily(columns: tuple[str, ...], digits: dict[str, int], literal: bool, so_far: bool = False) -> str:
    measures = _measures(literal) | (_states_so_far() if so_far else {})
    ctes = _clean(literal) | {f"part_{name}": sql for name, sql in measures.items()}
    joins = " ".join(f"LEFT JOIN part_{name} USING (date)" for name in measures)

    def value(name):
        if name == "id":
            return "CAST(row_number() OVER (ORDER BY date DESC) AS INT) AS id"
        if name in ("date",):
            return "date"
        if name in ("channel", "brand", "region"):
            return f"coalesce({name}, 'N/A') AS {name}"
        if name in digits:
            return f"round(CASE WHEN isnan({name}) OR {name} IS NULL THEN 0 ELSE {name} END, {digits[name]}) AS {name}"
        return f"coalesce({name}, 0) AS {name}"

    return _with(ctes, f"SELECT {', '.join(map(value, columns))} FROM spine {joins}")
