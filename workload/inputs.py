"""Raw all-text member, transaction and campaign tables derived from the given star schema.

The SELECTs run unchanged on Spark and on DuckDB, so both sides start from the same raw rows. They
use every row of their tables. The CASE arms turn some cells into what real exports contain: ids
with a trailing ``.0`` or blanks, words for blank cells, several date spellings, shared cards.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from daybook import Config, Tables

CONFIG = Config(
    spine_start=dt.date(1996, 1, 1),
    focus_channel="store",
    program_channels=("store", "club", "clubweb", "shopweb"),
    category_keyword="promo",
    base_overrides={dt.date(1999, 6, 1): 41250, dt.date(2000, 2, 29): 17},
)
LITERAL = replace(CONFIG, semantics="reference")
SO_FAR = replace(CONFIG, state_purchases="so_far")

MEMBERS = """
SELECT CASE WHEN c_custkey % 97 = 5 THEN 'None'
            WHEN c_custkey % 50 = 49 THEN concat(' ', c_custkey - 1, '.0')
            WHEN c_custkey % 59 = 6 THEN concat(c_custkey, ' .0')
            WHEN c_custkey % 3 = 0 THEN concat(c_custkey, '.0')
            WHEN c_custkey % 41 = 1 THEN concat(c_custkey, '.0 ')
            ELSE concat('', c_custkey) END AS card_no,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'STORE' WHEN 'MACHINERY' THEN 'Club'
            WHEN 'FURNITURE' THEN 'clubweb' WHEN 'BUILDING' THEN 'ShopWeb' ELSE 'kiosk' END
         AS enrollment_channel_code,
       CASE WHEN c_custkey % 83 = 7 THEN 'bad-date'
            WHEN c_custkey % 4 = 1
            THEN concat(CAST(DATE '1995-01-01' + CAST(c_custkey * 37 % 1500 AS INT) AS VARCHAR(10)), ' 00:00:00')
            ELSE CAST(DATE '1995-01-01' + CAST(c_custkey * 37 % 1500 AS INT) AS VARCHAR(10)) END
         AS enrollment_date,
       CASE WHEN c_custkey % 11 = 0 THEN 'NaT'
            ELSE CAST(DATE '1960-01-01' + CAST(c_custkey * 97 % 15000 AS INT) AS VARCHAR(10)) END AS dob,
       CASE WHEN c_custkey % 7 = 0 THEN 'None'
            ELSE CAST(DATE '1985-01-01' + CAST(c_custkey * 53 % 5000 AS INT) AS VARCHAR(10)) END AS anniversary,
       CASE WHEN c_custkey % 61 = 3 THEN '50' WHEN c_custkey % 67 = 5 THEN '50.000001'
            WHEN c_custkey % 71 = 6 THEN '1267650600228229401496703205376' WHEN c_custkey % 29 = 2 THEN 'nan'
            ELSE CAST(CAST(c_acctbal / 50 AS DECIMAL(12,4)) AS VARCHAR(20)) END AS point_balance
FROM {customer}
"""
TRANSACTIONS = """
SELECT CASE WHEN o_orderkey % 89 = 4 THEN 'None'
            WHEN l_linenumber % 2 = 0 THEN concat(o_custkey, '.0')
            WHEN o_orderkey % 53 = 8 THEN concat(' ', o_custkey, ' ')
            ELSE concat('', o_custkey) END AS card_no,
       CASE WHEN o_orderkey % 101 = 9 AND l_linenumber = 1 THEN 'not a date'
            WHEN l_linenumber = 3 THEN concat(day, 'T10:00:00') ELSE day END AS invoice_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Store' WHEN '2-HIGH' THEN 'club'
            WHEN '3-MEDIUM' THEN 'CLUBWEB' WHEN '4-NOT SPECIFIED' THEN 'shopweb' ELSE 'kiosk' END AS channel,
       p_type AS category,
       CASE WHEN l_orderkey % 997 = 5 THEN '0.00001' WHEN l_orderkey % 9973 = 7 THEN '1267650600228229401496703205376'
            WHEN l_linenumber % 5 = 0 THEN '0' WHEN l_linenumber % 7 = 0 THEN NULL
            WHEN l_quantity = 1 THEN '0.5' WHEN l_orderkey % 9973 = 3 THEN 'nan'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(24)) END AS eligible_amt
FROM {lineitem}
JOIN (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS day FROM {orders}) AS dated
  ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
"""
CAMPAIGNS = """
SELECT CASE event_id % 8
         WHEN 1 THEN concat(day, ' 09:30:00')
         WHEN 2 THEN concat(substr(day, 9, 2), '-', substr(day, 6, 2), '-', substr(day, 1, 4))
         WHEN 3 THEN concat('31-02-', substr(day, 1, 4))
         WHEN 4 THEN concat(day, 'xyz')
         WHEN 5 THEN concat(substr(day, 9, 2), '-', substr(day, 6, 2), '-', substr(day, 1, 4), ' 09:30:00')
         WHEN 6 THEN concat(substr(day, 1, 4), '/', substr(day, 6, 2), '/', substr(day, 9, 2))
         ELSE day END AS deployment_date,
       CASE WHEN event_id % 13 = 0 THEN '1,200' WHEN event_id % 17 = 0 THEN '99999999999'
            WHEN event_id % 1013 = 11 THEN '1267650600228229401496703205376'
            ELSE concat(' ', user_id, ' ') END AS target_count,
       CASE WHEN event_id % 19 = 0 THEN '12.0' ELSE concat('', user_id % 10) END AS buyers,
       CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 3 = 0
            THEN concat('-', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR(24)))
            ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR(24)) END AS incremental_rev,
       CASE WHEN event_id % 23 = 0 THEN '1e3' WHEN event_id % 29 = 3 THEN '0.123456789'
            WHEN event_id % 1009 = 7 THEN '1267650600228229401496703205376'
            ELSE CAST(CAST(value * 4 AS DECIMAL(18,2)) AS VARCHAR(24)) END AS sale_value_1,
       CASE WHEN event_id % 5 = 0 THEN '12%' ELSE concat('0.', user_id % 10) END AS conversion_1,
       CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS channel,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('brand ', user_id % 7) END AS brand,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('region ', user_id % 3) END AS region
FROM (SELECT *, CAST(DATE '1997-01-01' + CAST(event_id * 13 % 1500 AS INT) AS VARCHAR(10)) AS day
      FROM {events}) AS dated
"""


def _select(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names})


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, MEMBERS, "customer")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, TRANSACTIONS, "lineitem", "orders", "part")


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, CAMPAIGNS, "events")


def tables(spark: SparkSession, sf_dir: str, cfg: Config = CONFIG) -> Tables:
    return Tables(
        lambda: raw_members(spark, sf_dir),
        lambda: raw_transactions(spark, sf_dir),
        lambda: raw_campaigns(spark, sf_dir),
        cfg,
    )
