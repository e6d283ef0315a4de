"""Splitting a database read by predicates, for tables without a number to split by.

The points that cut a text, date or number column into parts of about equal size come from a table that has the column's
values (an earlier snapshot, or a read of that column alone). They make a list of predicates, one task each. Every row, nulls
included, satisfies exactly one of them, also rows that the table of the points did not have.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from daybook.sources.scratch import scratch

Point = str | int | Decimal | dt.date | dt.datetime
_SPLITTABLE = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.IntegralType, T.DecimalType)


def split_points(values: DataFrame, column: str, parts: int) -> list[Point]:
    """At most ``parts - 1`` rising values: the k-th is the smallest one that at least k / ``parts`` of all values lie below.

    Values are counted before they are sorted, so one with a third of all rows is one row; it is never cut, and where it
    spans several points there are fewer. The order is that of Spark: texts by code point. Nulls have no place in it.
    The counts are sorted in ranges and added up within each; the driver gets the points only.
    """
    kind = values.schema[column].dataType
    if not isinstance(kind, _SPLITTABLE):
        raise ValueError(f"{column} is a {kind.simpleString()}: split by a text, a date or an exact number")
    if parts < 2:
        raise ValueError("a read is split into at least two parts")
    spark = values.sparkSession
    counts = values.select(F.col(f"`{column}`").alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
    path = f"{scratch(spark, 'splits')}/counts"
    # written, since the ranges come from a sample and must stay as they are
    counts.repartitionByRange("value").withColumn("range", F.spark_partition_id()).write.parquet(path)
    counts = spark.read.schema("value {}, n long, range int".format(kind.simpleString())).parquet(path)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranges = counts.groupBy("range").agg(F.sum("n").alias("size")).select(
        "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("total")
    )
    inside = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranked = counts.join(ranges, "range").select("value", below.alias("below"), "total")
    placed = ranked.select("value", F.expr(f"below * {parts} div total").alias("part"))
    points = placed.where("part > 0").groupBy("part").agg(F.min("value").alias("value"))
    return [row["value"] for row in points.orderBy("value").collect()]


def literal(point: Point, backslash: str = "\\") -> str:
    """A value in SQL; ``backslash`` is how the database wants one written inside a text."""
    if isinstance(point, dt.datetime):
        return f"TIMESTAMP '{point.isoformat(' ')}'"
    if isinstance(point, dt.date):
        return f"DATE '{point.isoformat()}'"
    if isinstance(point, str):
        quoted = point.replace("\\", backslash).replace("'", "''")
        return f"'{quoted}'"
    return str(point)


def split_predicates(expression: str, points: Sequence[Point], backslash: str = "\\") -> list[str]:
    """One condition per part, from the points in rising order; nulls belong to the first part.

    The database has to order ``expression`` as the points are: for texts name a collation by code point
    (``card_no COLLATE "C"``), else rows between two points may be read twice.
    """
    if not points:
        return ["1 = 1"]
    marks = [literal(point, backslash) for point in points]
    inner = [f"{expression} >= {low} AND {expression} < {high}" for low, high in zip(marks, marks[1:])]
    return [f"{expression} < {marks[0]} OR {expression} IS NULL", *inner, f"{expression} >= {marks[-1]}"]


def read_database_by_predicates(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], fetch_size: int = 10_000,
    connection: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table over JDBC, one task per predicate. ``connection`` (user, password, driver, ...) comes from the caller."""
    properties = {**(connection or {}), "fetchsize": str(fetch_size)}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
