"""Where raw tables come from."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook.functions.headers import clean_headers


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.read.table(name)


def read_files(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(format).options(**options).load(path)


# A record at the start of a text: quoted cells may hold line breaks, and a quote inside them is doubled.
FIRST_RECORD = r'^\s*((?:[^"\r\n]|"(?:[^"]|"")*")*)'


def csv_headers(spark: SparkSession, path: str, **options: str) -> list[tuple[str, str]]:
    """Each csv file below a path with its first record as it stands there; files without any are left out.

    One scan for all files, which brings a line per file to the driver. Of a file in several blocks only the first
    block can have the header.
    """
    multi_line = str(options.get("multiLine", "false")).lower() == "true"
    lines = spark.read.text(path, wholetext=multi_line).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    written = lines.where((F.col("block") == 0) & (F.length(F.trim("value")) > 0))
    first = written.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    if multi_line:
        first = first.withColumn("header", F.regexp_extract("header", FIRST_RECORD, 1))
    return sorted((row["file"], row["header"].lstrip("\ufeff")) for row in first.collect())


def _cells(header: str, options: Mapping[str, str]) -> list[str | None]:
    separator = options.get("sep", options.get("delimiter", ","))
    cells = next(csv.reader(io.StringIO(header, newline=""), delimiter=separator, quotechar=options.get("quote", '"')))
    return [cell or None for cell in cells]


def read_csv_export(spark: SparkSession, path: str, first_column: str | None = None, **options: str) -> DataFrame:
    """A csv export with a header row in each file: clean unique column names, all columns text.

    Files may order their columns differently or lack some (null there): every file is read by its own
    header, whose repeated and blank cells keep their meaning. All headers come from one scan, and one scan
    reads all files by position; where headers differ, a file's header says which position a column has.
    ``first_column`` renames the first column of every file. A cell with a line break needs the option ``multiLine``.
    """
    options = {"escape": '"', **options}
    headers = csv_headers(spark, path, **options)
    if not headers:
        raise ValueError(f"no header row in {path}")
    cleaned = {header: tuple(clean_headers(_cells(header, options), first_column)) for header in {h for _, h in headers}}
    kinds = list(dict.fromkeys(cleaned[header] for _, header in headers))
    width = max(map(len, kinds))
    by_place = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.options(**options).schema(by_place).csv(path, header=True)
    if len(kinds) == 1:
        return rows.toDF(*kinds[0])
    index = spark.createDataFrame(
        [(file, kinds.index(cleaned[header])) for file, header in headers], "file string, kind int"
    )
    rows = rows.select("*", F.col("_metadata.file_path").alias("file")).join(index, "file")

    def column(name: str) -> Column:
        places: dict[int, list[int]] = {}
        for kind, names in enumerate(kinds):
            if name in names:
                places.setdefault(names.index(name), []).append(kind)
        return F.coalesce(*[F.when(F.col("kind").isin(*some), F.col(f"_c{place}")) for place, some in places.items()])

    return rows.select(*[column(name).alias(name) for name in dict.fromkeys(n for names in kinds for n in names)])


def jdbc_options(
    url: str,
    table: str,
    partition_column: str,
    lower_bound: str | int,
    upper_bound: str | int,
    num_partitions: int,
    fetch_size: int = 10_000,
    connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a database read that is split over ``num_partitions`` tasks.

    The bounds only set the split: rows outside them, and rows with a null in the partition column,
    are read as well. ``connection`` (user, password, driver, ...) comes from the caller.
    """
    if num_partitions < 2:
        raise ValueError("a database table is read by at least two tasks; give num_partitions >= 2")
    return {
        **(connection or {}),
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
    }


def read_database(spark: SparkSession, **settings) -> DataFrame:
    """A database table over JDBC; see ``jdbc_options`` for the settings."""
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
