"""Runs registered queries against their SQL: ``python -m workload.compare [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from workload.queries import QUERIES
from workload.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, Decimal):
        return float(value)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None when the query and its SQL give the same rows, else what differs."""
    run, sql = QUERIES[name]
    ours = run(spark, sf_dir)
    our_names, our_rows = _bag(ours.columns, ours.collect())
    result = connection.execute(sql)
    their_names, their_rows = _bag([column[0] for column in result.description], result.fetchall())
    if our_names != their_names:
        return f"columns {our_names} against {their_names}"
    if our_rows != their_rows:
        extra, missing = our_rows - their_rows, their_rows - our_rows
        return (
            f"{our_names}: {extra.total()} rows too many, {missing.total()} missing; e.g. "
            f"{sorted(extra, key=str)[:3]} against {sorted(missing, key=str)[:3]}"
        )
    return None if our_rows else "no rows"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = local_session(), connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        begin = time.perf_counter()
        try:
            found = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report every query, then fail
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.perf_counter() - begin:.1f}s {found or ''}", flush=True)
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
