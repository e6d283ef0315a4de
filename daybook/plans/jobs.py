"""The jobs a user schedules. Each is a read, a transformation and a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.config import Config
from daybook.functions.headers import as_text, standardise_headers
from daybook.plans.daily import daily
from daybook.sources.published import publish
from daybook.sources.tables import Tables
from daybook.sources.writers import write_csv, write_parquet, write_snapshot

MONTH = "invoice_month"
_TABLES = ("members", "transactions", "campaigns")


def daily_job(
    members: DataFrame, transactions: DataFrame, campaigns: DataFrame, cfg: Config, path: str, staged: bool = False
) -> None:
    """Raw tables to the consolidated frame, written over the last one.

    ``staged`` writes it beside the last one, which readers (``sources.published.read_published``) see until it is complete.
    """
    frame = daily(Tables(members, transactions, campaigns, cfg), cfg)
    if staged:
        publish(frame, path)
    else:
        write_parquet(frame, path)


def clean_job(
    members: DataFrame, transactions: DataFrame, campaigns: DataFrame, cfg: Config, path: str, by_month: bool = False
) -> None:
    """The cleaned, typed tables as parquet, for when several jobs read them: text is parsed once
    and later scans read a few compact columns, to which filters are pushed.

    ``by_month`` partitions the transactions by the month of the invoice (``invoice_month``, its first day).
    """
    tables = Tables(members, transactions, campaigns, cfg)
    for name in _TABLES:
        table, partitions = getattr(tables, name), ()
        if by_month and name == "transactions":
            table, partitions = table.withColumn(MONTH, F.trunc("invoice_date", "month")), (MONTH,)
            table = table.repartition(MONTH, F.hash("card_no") % 16)  # a few files per month
        write_parquet(table, f"{path}/{name}", partition_by=partitions)


def read_clean(spark: SparkSession, path: str) -> Tables:
    """The tables ``clean_job`` wrote."""
    return Tables.from_clean(*[spark.read.parquet(f"{path}/{name}") for name in _TABLES])


def snapshot_job(table: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> int:
    """A copy of a table as parquet; returns the number of rows."""
    return write_snapshot(table, path, mode, partition_by)


def standardise(raw: DataFrame, first_column: str | None = None) -> DataFrame:
    """Clean column names, all columns text."""
    return as_text(standardise_headers(raw, first_column))


def text_parquet_job(raw: DataFrame, path: str, first_column: str | None = None) -> None:
    """A raw export as parquet with clean names and text columns."""
    write_parquet(standardise(raw, first_column), path)


def csv_job(raw: DataFrame, path: str, first_column: str | None = None) -> None:
    """A raw export as csv, names as they are but for the first column."""
    if first_column is not None:
        raw = raw.toDF(first_column, *raw.columns[1:])
    write_csv(raw, path)
