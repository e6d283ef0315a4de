"""Every registered query: the Spark side and, next to it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybook import daily
from daybook.functions import dates, ids, numbers
from daybook.operators import kpis
from daybook.operators.cards import card_days
from daybook.operators.population import population_by_day, population_in_spells
from daybook.operators.spine import date_spine, spine_bounds
from daybook.plans.clustered import cluster_job, read_clustered
from daybook.plans.daily import COLUMNS
from daybook.plans.jobs import clean_job, csv_job, daily_job, read_clean, snapshot_job, standardise, text_parquet_job
from daybook.plans.refresh import CHANGE, DailyState
from daybook.sources.published import publish, read_published
from daybook.sources.readers import read_csv_export, read_files, read_table
from daybook.sources.rejects import conform_job, read_quarantine
from daybook.sources.schemas import (
    CAMPAIGN_DDL,
    TRANSACTION_DDL,
    campaign_schema,
    conform,
    member_ddl,
    member_schema,
    transaction_schema,
)
from daybook.sources.scratch import scratch
from daybook.sources.splits import split_points, split_predicates
from workload import oracles
from workload.inputs import CONFIG, LITERAL, SO_FAR, raw_campaigns, raw_members, raw_transactions, tables

Query = Callable[[SparkSession, str], DataFrame]

# Digits that doubles are rounded to before both sides are compared.
DIGITS = {
    "newcustomersales": 2, "repeatcustomersales": 2, "transactedcustomersales": 2,
    "birthdaycustomersales": 2, "annvcustomersales": 2, "incrementalrev": 2,
    "sale_value_1": 2, "conversion_1": 6,
}

# Query -> function, name of its SQL, and its columns where they are more than that name.
MEASURES = {
    "q_m01_new_customers": (kpis.new_customers, "newcustomercount"),
    "q_m02_repeat_customers": (kpis.repeat_customers, "repeatcustomercount"),
    "q_m03_total_customers": (kpis.total_customers, "totalcustomertransactions"),
    "q_m04_new_customer_sales": (kpis.new_customer_sales, "newcustomersales"),
    "q_m05_repeat_customer_sales": (kpis.repeat_customer_sales, "repeatcustomersales"),
    "q_m06_transacted_sales": (kpis.transacted_sales, "transactedcustomersales"),
    "q_m07_birthday_customers": (kpis.birthday_customers, "birthdaycustomercount"),
    "q_m08_birthday_sales": (kpis.birthday_sales, "birthdaycustomersales"),
    "q_m09_anniversary_customers": (kpis.anniversary_customers, "anncustomercount"),
    "q_m10_anniversary_sales": (kpis.anniversary_sales, "annvcustomersales"),
    "q_m11_birthdays_per_day": (kpis.birthdays_per_day, "customerbirthdaysperday"),
    "q_m12_anniversaries_per_day": (kpis.anniversaries_per_day, "customeranniversariesperday"),
    "q_m13_enrolled_customers": (kpis.enrolled_customers, "enrolledcustomercount"),
    "q_m14_members_archived": (kpis.members_archived, "membersarchived"),
    "q_m15_cross_channel_buyers": (kpis.cross_channel_buyers, "crosschannelbuyers"),
    "q_m16_keyword_buyers": (kpis.keyword_buyers, "diamondenthusiasts"),
    "q_m17_dormant_customers": (kpis.dormant_customers, "dormantcustomers"),
    "q_m18_low_point_balance": (kpis.low_point_balance_customers, "lowpointbalancecustomers"),
    "q_m19_active_customers": (kpis.active_customers, "activecustomers"),
    "q_m20_campaigns_deployed": (kpis.campaigns_deployed, "campaignsdeployed"),
    "q_m21_targeted_count": (kpis.targeted_count, "targetedcount"),
    "q_m22_campaign_buyers": (kpis.campaign_buyers, "buyers"),
    "q_m23_incremental_revenue": (kpis.incremental_revenue, "incrementalrev"),
    "q_m24_campaign_details": (
        kpis.campaign_details, "details", "sale_value_1", "conversion_1", "channel", "brand", "region"
    ),
    "q_m25_base_override": (kpis.previous_month_base, "previousmonthbase"),
}


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS[name]) for name in df.columns if name in DIGITS})


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_files(spark, f"{sf_dir}/{name}.parquet")


def _daily(cfg) -> Query:
    return lambda spark, sf_dir: _rounded(daily(tables(spark, sf_dir, cfg), cfg))


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_spine(spine_bounds(tables(spark, sf_dir), CONFIG))


SPINE_SQL = oracles.with_clean("SELECT date FROM spine")


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order so far."""
    orders = _read(spark, sf_dir, "orders")
    entries = orders.select(
        F.col("o_custkey").alias("card_no"), F.col("o_orderdate").cast("date").alias("entry")
    )
    return population_by_day(entries, spine(spark, sf_dir), CONFIG.spine_start, "customers")


POPULATION_SQL = oracles.with_clean("""
    SELECT date, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers
    FROM spine LEFT JOIN orders ON CAST(o_orderdate AS DATE) <= date GROUP BY date""")


def in_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a line that is ordered and not shipped yet, which overlap."""
    orders, lines = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    spells = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("card_no"),
        F.col("o_orderdate").cast("date").alias("entry"),
        F.col("l_shipdate").cast("date").alias("exit"),
    )
    return population_in_spells(spells, spine(spark, sf_dir), CONFIG.spine_start, "customers")


IN_SPELLS_SQL = oracles.with_clean("""
    SELECT date, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers
    FROM spine LEFT JOIN (
        SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS ordered, CAST(l_shipdate AS DATE) AS shipped
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey) AS on_the_way
      ON ordered <= date AND date < shipped
    GROUP BY date""")


def clean_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir)
    column, data_type = F.col("card_no"), raw.schema["card_no"].dataType
    return raw.select(
        column.alias("raw"),
        ids.clean_id(column, data_type, CONFIG).alias("card"),
        ids.clean_id(column, data_type, LITERAL).alias("literal_card"),
    ).groupBy("raw", "card", "literal_card").agg(F.count("*").alias("lines"))


CLEAN_IDS_SQL = f"""
    SELECT card_no AS raw, {oracles.clean_id('card_no', False)} AS card,
           {oracles.clean_id('card_no', True)} AS literal_card, count(*) AS lines
    FROM ({oracles.RAW_TRANSACTIONS}) AS raw_transactions GROUP BY 1, 2, 3"""


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_campaigns(spark, sf_dir)
    text, data_type = F.col("deployment_date"), raw.schema["deployment_date"].dataType
    return raw.select(
        text,
        dates.to_day(text).alias("plain"),
        dates.deployment_day(text, data_type, CONFIG).alias("deployed"),
        dates.deployment_day(text, data_type, LITERAL).alias("literal_deployed"),
        dates.deployment_day_whole_text(text, data_type, LITERAL).alias("literal_counted"),
    )


PARSE_DATES_SQL = f"""
    SELECT deployment_date, {oracles.day('deployment_date')} AS plain,
           {oracles.deployed('deployment_date', False)} AS deployed,
           {oracles.deployed('deployment_date', True)} AS literal_deployed,
           CASE WHEN regexp_matches(deployment_date, '^[0-9]{{4}}-') THEN {oracles.day('deployment_date')}
                ELSE {oracles.deployed('deployment_date', True)} END AS literal_counted
    FROM ({oracles.RAW_CAMPAIGNS}) AS raw_campaigns"""


def guarded_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["target_count", "buyers", "incremental_rev", "sale_value_1", "conversion_1"]
    return raw_campaigns(spark, sf_dir).select(
        *columns,
        numbers.guarded_int(F.col("target_count"), data_type="double").alias("targets"),
        numbers.guarded_int(F.col("buyers"), "null").cast("double").alias("buyers_or_null"),
        *[numbers.guarded_decimal(F.col(name), "double").alias(f"{name}_number") for name in columns[2:]],
    )


GUARDED_NUMBERS_SQL = f"""
    SELECT target_count, buyers, incremental_rev, sale_value_1, conversion_1,
           {oracles.whole('target_count', False)} AS targets,
           CASE WHEN regexp_full_match(trim(buyers), '[0-9]+') THEN CAST(trim(buyers) AS DOUBLE) END AS buyers_or_null,
           CAST({oracles.figure('incremental_rev')} AS DOUBLE) AS incremental_rev_number,
           CAST({oracles.figure('sale_value_1')} AS DOUBLE) AS sale_value_1_number,
           CAST({oracles.figure('conversion_1')} AS DOUBLE) AS conversion_1_number
    FROM ({oracles.RAW_CAMPAIGNS}) AS raw_campaigns"""


def header_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table under headers as spreadsheets have them, and what is made of them."""
    return standardise(_messy_customers(spark, sf_dir), first_column="MonthYear")


def _messy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    ).toDF("Key", "Full Name ", "Share %", "Full Name", "Seg.ment")


HEADER_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS monthyear, c_name AS full_name, CAST(c_nationkey AS VARCHAR) AS share_pct,
           CAST(c_acctbal AS VARCHAR) AS full_name_1, c_mktsegment AS segment FROM customer"""


def conform_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines fitted to the declared transaction table: its types, and a column they lack."""
    names = {
        "l_orderkey": "TransactionId", "l_linenumber": "id", "l_partkey": "storecode", "l_quantity": "QTY",
        "l_extendedprice": "shopping_amount", "l_discount": "discountheader", "l_shipdate": "invoice_date",
        "l_returnflag": "channel", "l_linestatus": "brand", "l_tax": "not_declared",
    }
    lines = _read(spark, sf_dir, "lineitem").select(*names).withColumnsRenamed(names)
    return conform(lines, transaction_schema())


CONFORM_SQL = oracles.conformed(TRANSACTION_DDL, "lineitem", {
    "id": "l_linenumber", "transactionid": "l_orderkey", "invoice_date": "l_shipdate", "channel": "l_returnflag",
    "brand": "l_linestatus", "qty": "l_quantity", "storecode": "l_partkey", "shopping_amount": "l_extendedprice",
    "discountheader": "l_discount",
})


def conform_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers fitted to the declared member table."""
    names = {"c_custkey": "ID", "c_name": "firstname", "c_acctbal": "PointBalance", "c_mktsegment": "enrollmentchannelcode"}
    customers = _read(spark, sf_dir, "customer").select(*names).withColumnsRenamed(names)
    return conform(customers, member_schema("club"))


CONFORM_MEMBERS_SQL = oracles.conformed(member_ddl("club"), "customer", {
    "id": "c_custkey", "firstname": "c_name", "pointbalance": "c_acctbal", "enrollmentchannelcode": "c_mktsegment",
})


def conform_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events fitted to the declared campaign table."""
    names = {"event_id": "id", "event_type": "channel", "value": "SALE_VALUE", "user_id": "sl_no"}
    return conform(_read(spark, sf_dir, "events").select(*names).withColumnsRenamed(names), campaign_schema())


CONFORM_CAMPAIGNS_SQL = oracles.conformed(
    CAMPAIGN_DDL, "events", {"id": "event_id", "Channel": "event_type", "Sale_Value": "value", "Sl_No": "user_id"}
)


CAMPAIGN_TYPES = """
    deployment_date DATE, target_count INT NOT NULL, buyers INT, incremental_rev DECIMAL(4,2), sale_value_1 DECIMAL(15,2),
    conversion_1 DOUBLE, channel STRING NOT NULL, brand STRING, sl_no INT NOT NULL"""


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the raw campaigns that do not fit a typed schema, from one written pass over them."""
    path = scratch(spark, "conformed")
    counts = conform_job(raw_campaigns(spark, sf_dir), T.StructType.fromDDL(CAMPAIGN_TYPES), path)
    observed = spark.createDataFrame([(*name, n) for name, n in counts.items()], "column string, reason string, observed long")
    found = read_quarantine(spark, path).groupBy("column", "reason").agg(
        F.count("*").alias("cells"), F.max("cell").alias("largest")
    )
    return found.join(observed, ["column", "reason"], "full")


def _quarantine_sql() -> str:
    def count(column, reason, where, cell=None):
        return (
            f"SELECT '{column}' AS \"column\", '{reason}' AS reason, count(*) AS cells, max({cell or column}) AS largest, "
            f"count(*) AS observed FROM raw WHERE {where} HAVING count(*) > 0"
        )

    whole, number = "'[+-]?[0-9]+'", "'[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'"

    def counted(column):
        is_whole, is_number = (f"regexp_full_match(trim({column}), {pattern})" for pattern in (whole, number))
        return [
            count(column, "out of range", f"{is_whole} AND TRY_CAST(trim({column}) AS INT) IS NULL"),
            count(column, "not whole", f"{is_number} AND NOT {is_whole}"),
            count(column, "unreadable", f"NOT {is_number}"),
        ]

    def measured(column, limit):
        is_number = f"regexp_full_match(trim({column}), {number})"
        far = f"abs(CASE WHEN {is_number} THEN CAST(trim({column}) AS DOUBLE) END) >= {limit}"
        return [count(column, "out of range", far), count(column, "unreadable", f"NOT {is_number}")]

    parts = [
        count("deployment_date", "unreadable", f"deployment_date IS NOT NULL AND {oracles.day('deployment_date')} IS NULL"),
        *counted("target_count"), *counted("buyers"), *measured("incremental_rev", 99.995), *measured("sale_value_1", 1e13),
        measured("conversion_1", 1e300)[1], count("channel", "missing", "channel IS NULL"),
        count("sl_no", "missing", "TRUE", "CAST(NULL AS VARCHAR)"),
    ]
    return f"WITH raw AS ({oracles.RAW_CAMPAIGNS}) {' UNION ALL '.join(parts)}"


def split_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per part of the order lines, split by dates and by texts, and how many parts a row is in at most."""
    lines, parts = _read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "part")
    frames = []
    for table, column, expression in (
        (lines.select(F.col("l_shipdate").cast("date").alias("value")), "l_shipdate", 8),
        (parts.select(F.col("p_type").alias("value")), "p_type", 6),
        (lines.select(F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("value")), "l_returnflag", 5),
    ):
        points = split_points(table, "value", expression)
        tests = [F.expr(f"coalesce({predicate}, FALSE)") for predicate in split_predicates("value", points, "\\\\")]
        held = F.filter(F.array(*[F.when(test, F.lit(i)) for i, test in enumerate(tests)]), lambda i: i.isNotNull())
        frames.append(
            table.select(held.alias("held"), F.col("value").cast("string").alias("value"))
            .groupBy(F.lit(column).alias("split_by"), F.col("held")[0].alias("part"))
            .agg(F.count("*").alias("lines"), F.max(F.size("held")).alias("parts_of_a_row"), F.min("value").alias("least"))
        )
    return frames[0].union(frames[1]).union(frames[2])


def _split_sql() -> str:
    def parts(column, value, table, n):
        return f"""
            SELECT '{column}' AS split_by, CAST(coalesce(part, 0) AS INT) AS part, count(*) AS lines, 1 AS parts_of_a_row,
                   min(CAST(value AS VARCHAR)) AS least
            FROM (SELECT {value} AS value FROM {table}) AS given LEFT JOIN (
                SELECT value, dense_rank() OVER (ORDER BY share) - 1 AS part FROM (
                    SELECT value, CAST(floor((sum(n) OVER (ORDER BY value) - n) * {n} // sum(n) OVER ()) AS INT) AS share
                    FROM (SELECT {value} AS value, count(*) AS n FROM {table} WHERE {value} IS NOT NULL GROUP BY 1) AS c) AS s) AS p
              USING (value) GROUP BY 1, 2"""

    return " UNION ALL ".join([
        parts("l_shipdate", "CAST(l_shipdate AS DATE)", "lineitem", 8),
        parts("p_type", "p_type", "part", 6),
        parts("l_returnflag", "CASE WHEN l_linenumber > 1 THEN l_returnflag END", "lineitem", 5),
    ])


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, published after a result that lacked some of them, from that result and the rest."""
    path, orders = scratch(spark, "published"), _read(spark, sf_dir, "orders")
    is_late = F.col("o_orderstatus") == "O"
    publish(orders.where(~is_late), path)
    rows = publish(read_published(spark, path).union(orders.where(is_late)), path)
    return read_published(spark, path).withColumn("rows_written", F.lit(rows).cast("long"))


def catalog_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders through the catalog."""
    _read(spark, sf_dir, "orders").createOrReplaceTempView("daybook_orders")
    return read_table(spark, "daybook_orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


CATALOG_SQL = "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1"


def _raw_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [raw_members(spark, sf_dir), raw_transactions(spark, sf_dir), raw_campaigns(spark, sf_dir)]


def written_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job's written frame."""
    path = scratch(spark, "daily")
    daily_job(*_raw_tables(spark, sf_dir), CONFIG, path)
    return _rounded(read_files(spark, path))


# Cells that are wrong at first, per raw table.
WRONG = {
    "members": {"enrollment_date": "1995-01-02", "point_balance": "7", "dob": "1972-02-29"},
    "transactions": {"eligible_amt": "1e30", "channel": "Store", "invoice_date": "1996-03-05"},
    "campaigns": {"incremental_rev": "10000000000000000000000.5", "brand": "brand to go", "deployment_date": "1998-05-05"},
}


# Column of the raw rows that are dealt out to the loads, by all of a row's cells.
PART = "part"


def dealt(raw: DataFrame) -> DataFrame:
    return raw.withColumn(PART, F.pmod(F.xxhash64(*raw.columns), F.lit(8)).cast("int"))


def written_parts(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """The dealt rows from a written table with a folder per part: the raw rows are made once, and a load reads its parts only."""
    rows, path = dealt(raw), f"{scratch(spark, 'raw')}/rows"
    rows.write.partitionBy(PART).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def changes(raw: DataFrame, wrong: dict[str, str]) -> list[DataFrame]:
    """Four loads that amount to the raw table: most rows, some of them wrong and some that do not belong; late rows;
    corrections; more late rows and the withdrawal of what does not belong."""
    part, parts = F.col(PART), raw if PART in raw.columns else dealt(raw)
    spoilt = {name: F.lit(text) for name, text in wrong.items()}

    def rows(condition, change: int, is_wrong: bool = False) -> DataFrame:
        some = parts.where(condition).drop(PART)
        return (some.withColumns(spoilt) if is_wrong else some).withColumn(CHANGE, F.lit(change))

    strangers = part == 0
    return [
        rows(part < 5, 1).union(rows(part == 5, 1, True)).union(rows(strangers, 1, True)),
        rows(part == 6, 1),
        rows(part == 5, -1, True).union(rows(part == 5, 1)),
        rows(part == 7, 1).union(rows(strangers, -1, True)),
    ]


def refreshed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily frame of a state after a first load and three loads of late and corrected rows."""
    state = DailyState(spark, scratch(spark, "state"), CONFIG)
    raws = [written_parts(spark, raw) for raw in _raw_tables(spark, sf_dir)]
    loads = [changes(raw, wrong) for raw, wrong in zip(raws, WRONG.values())]
    for number, (members, transactions, campaigns) in enumerate(zip(*loads)):
        state.refresh(members, transactions, campaigns, number)
    return _rounded(state.frame())


def written_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure from written clean tables, the transactions in months."""
    path = scratch(spark, "clean")
    clean_job(*_raw_tables(spark, sf_dir), CONFIG, path, by_month=True)
    return kpis.dormant_customers(read_clean(spark, path), CONFIG)


def clustered_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active customers from tables stored by card."""
    path, source = scratch(spark, "clustered"), tables(spark, sf_dir)
    name = f"daybook_{path.rsplit('-', 1)[-1]}"
    cluster_job(source, CONFIG, name, path, buckets=8)
    return kpis.active_customers(read_clustered(spark, source, name), CONFIG)


def text_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table under spreadsheet headers, written as text parquet and read back."""
    path = scratch(spark, "text")
    text_parquet_job(_messy_customers(spark, sf_dir), path, first_column="MonthYear")
    return read_files(spark, path)


def near_across_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days near the first ship date of the order's lines in any year, also across the year's end."""
    cfg = replace(CONFIG, wrap_year_end=True)
    day, event = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    pairs = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return pairs.select("l_orderkey", "l_linenumber", dates.near_event(day, event, cfg).alias("is_near"))


def _near_sql() -> str:
    def gap(shift: int) -> str:
        in_year = (
            f"make_date(year(o_orderdate) + {shift}, month(l_shipdate), CASE WHEN month(l_shipdate) = 2 AND day(l_shipdate) = 29 "
            f"THEN 28 ELSE day(l_shipdate) END)"
        )
        return f"abs(date_diff('day', {in_year}, CAST(o_orderdate AS DATE))) <= {CONFIG.event_window_days}"

    return f"""
        SELECT l_orderkey, l_linenumber, {gap(-1)} OR {gap(0)} OR {gap(1)} AS is_near
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table written as a partitioned snapshot and read back, with the observed row count."""
    path = scratch(spark, "snapshot") + "/orders"
    rows = snapshot_job(_read(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    return read_files(spark, path).withColumn("rows_written", F.lit(rows).cast("long"))


SNAPSHOT_SQL = "SELECT *, (SELECT count(*) FROM orders) AS rows_written FROM orders"


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw campaign table written as csv and read back, first column renamed."""
    path = scratch(spark, "csv")
    raw = raw_campaigns(spark, sf_dir)
    first, *others = raw.columns
    # two exports of different column order
    is_first = F.crc32("target_count") % 2 == 0
    for name, rows, columns in (("a", is_first, others), ("b", ~is_first, others[::-1])):
        csv_job(raw.where(rows).select(first, *columns), f"{path}/{name}", first_column="MonthYear")
    return read_csv_export(spark, f"{path}/*")


# A csv cell cannot tell an empty text from a null.
CSV_SQL = f"""
    SELECT deployment_date AS monthyear,
           * EXCLUDE (deployment_date) REPLACE (nullif(incremental_rev, '') AS incremental_rev)
    FROM ({oracles.RAW_CAMPAIGNS}) AS raw_campaigns"""


def event_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap between each member's birthday or anniversary and the member's purchases."""
    source = tables(spark, sf_dir)
    days = source.transactions.select("card_no", F.col("invoice_date").alias("day")).distinct()
    members = source.members.select("card_no", "dob", "anniversary").distinct()
    day, dob, anniversary = F.col("day"), F.col("dob"), F.col("anniversary")
    return days.join(members, "card_no").select(
        "card_no", "day", "dob", "anniversary",
        dates.event_in_year(dob, F.year(day)).alias("birthday"),
        dates.event_gap(day, dob).cast("double").alias("gap"),
        dates.near_event(day, dob, CONFIG).alias("is_near"),
        dates.event_in_year_capped(anniversary, F.year(day)).alias("literal_anniversary"),
    )


EVENT_WINDOW_SQL = oracles.with_clean("""
    SELECT card_no, day, dob, anniversary, birthday, CAST(date_diff('day', birthday, day) AS DOUBLE) AS gap,
           date_diff('day', birthday, day) BETWEEN -15 AND 15 AS is_near, literal_anniversary
    FROM (SELECT DISTINCT t.card AS card_no, t.day, m.dob, m.anniversary,
                 make_date(year(t.day), month(m.dob),
                   CASE WHEN month(m.dob) = 2 AND day(m.dob) = 29 THEN 28 ELSE day(m.dob) END) AS birthday,
                 make_date(year(t.day), month(m.anniversary), least(day(m.anniversary), 28)) AS literal_anniversary
          FROM t JOIN m USING (card)) AS gaps""")


def month_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month arithmetic on every order date: thresholds, and the first day past them."""
    days = _read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    day = F.col("day")
    return days.select(
        "day",
        F.add_months(day, -CONFIG.dormant_months).alias("six_before"),
        F.add_months(day, -CONFIG.archive_months).alias("thirty_six_before"),
        dates.first_after(day, CONFIG.dormant_months).alias("dormant_from"),
        dates.first_after(day, CONFIG.archive_months).alias("archived_from"),
    )


MONTH_THRESHOLD_SQL = """
    WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
    calendar AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM days),
        (SELECT max(day) FROM days) + INTERVAL 4 YEAR, INTERVAL 1 DAY)) AS DATE) AS d)
    SELECT day, CAST(day - INTERVAL 6 MONTH AS DATE) AS six_before,
           CAST(day - INTERVAL 36 MONTH AS DATE) AS thirty_six_before,
           min(d) FILTER (d - INTERVAL 6 MONTH > day) AS dormant_from,
           min(d) FILTER (d - INTERVAL 36 MONTH > day) AS archived_from
    FROM days JOIN calendar ON d > day GROUP BY day"""


def card_day_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = card_days(tables(spark, sf_dir).transactions, CONFIG)
    return facts.withColumn("amount", F.round(F.col("amount").cast("double"), 2))


CARD_DAYS_SQL = oracles.with_clean(f"""
    SELECT card AS card_no, day AS date, round(CAST(sum(amount) AS DOUBLE), 2) AS amount,
           bool_or(coalesce(channel = {oracles.FOCUS}, FALSE)) AS in_focus,
           bool_or(coalesce(channel <> {oracles.FOCUS}, FALSE)) AS elsewhere,
           bool_or(coalesce(channel = {oracles.FOCUS} AND contains(category, 'promo'), FALSE)) AS keyword_in_focus,
           bool_or(coalesce(channel = {oracles.FOCUS} AND nonzero, FALSE)) AS spent_in_focus,
           bool_or(coalesce(channel IN ({oracles.PROGRAM}) AND nonzero, FALSE)) AS spent_in_program
    FROM every_t GROUP BY card, day""")


def _measure(function, cfg=CONFIG) -> Query:
    return lambda spark, sf_dir: _rounded(function(tables(spark, sf_dir, cfg), cfg))


def _measure_sql(name: str, *columns: str, so_far: bool = False) -> str:
    return oracles.measure(name, list(columns) or [name], DIGITS, so_far)


QUERIES: dict[str, tuple[Query, str]] = {
    **{query: (_measure(function), _measure_sql(*sql)) for query, (function, *sql) in MEASURES.items()},
    "q_m26_daily": (_daily(CONFIG), oracles.daily(COLUMNS, DIGITS, literal=False)),
    "q_m26_daily_literal": (_daily(LITERAL), oracles.daily(COLUMNS, DIGITS, literal=True)),
    "q_archived_so_far": (_measure(kpis.members_archived, SO_FAR), _measure_sql("membersarchived", so_far=True)),
    "q_dormant_so_far": (_measure(kpis.dormant_customers, SO_FAR), _measure_sql("dormantcustomers", so_far=True)),
    "q_daily_so_far": (_daily(SO_FAR), oracles.daily(COLUMNS, DIGITS, literal=False, so_far=True)),
    "q_population_in_spells": (in_spells, IN_SPELLS_SQL),
    "q_spine": (spine, SPINE_SQL),
    "q_population_by_day": (population, POPULATION_SQL),
    "q_card_days": (card_day_facts, CARD_DAYS_SQL),
    "q_clean_ids": (clean_ids, CLEAN_IDS_SQL),
    "q_parse_dates": (parse_dates, PARSE_DATES_SQL),
    "q_guarded_numbers": (guarded_numbers, GUARDED_NUMBERS_SQL),
    "q_event_window": (event_window, EVENT_WINDOW_SQL),
    "q_month_threshold": (month_threshold, MONTH_THRESHOLD_SQL),
    "q_header_standardise": (header_standardise, HEADER_SQL),
    "q_conform": (conform_transactions, CONFORM_SQL),
    "q_conform_members": (conform_members, CONFORM_MEMBERS_SQL),
    "q_conform_campaigns": (conform_campaigns, CONFORM_CAMPAIGNS_SQL),
    "q_catalog_read": (catalog_read, CATALOG_SQL),
    "q_daily_job": (written_daily, oracles.daily(COLUMNS, DIGITS, literal=False)),
    "q_daily_refresh": (refreshed_daily, oracles.daily(COLUMNS, DIGITS, literal=False)),
    "q_clustered_active": (clustered_active, _measure_sql("activecustomers")),
    "q_clean_job": (written_clean, _measure_sql("dormantcustomers")),
    "q_text_parquet": (text_parquet, HEADER_SQL),
    "q_near_across_years": (near_across_years, _near_sql()),
    "q_snapshot_roundtrip": (snapshot_roundtrip, SNAPSHOT_SQL),
    "q_csv_roundtrip": (csv_roundtrip, CSV_SQL),
    "q_quarantine": (quarantined, _quarantine_sql()),
    "q_split_reads": (split_reads, _split_sql()),
    "q_published": (published, SNAPSHOT_SQL),
}
