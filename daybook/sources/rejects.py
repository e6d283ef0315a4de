"""Fitting a table to a schema without losing what does not fit.

    raw -> conformed columns and, per row, the cells that would not parse -> written once -> frame | quarantine
                                                                                 └ counts, observed in the write

``sources.schemas.conform`` makes unreadable cells null. Here the same cells are kept beside the row they came from, with the
reason, so one scan gives the conformed rows, the quarantine and its counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from daybook.functions.numbers import NUMBER
from daybook.sources.schemas import conform
from daybook.sources.writers import write_parquet

REJECTS = "_rejects"
_CELL = "array<struct<column: string, reason: string, cell: string>>"
# Why a cell is not in the conformed row.
MISSING, UNREADABLE, NOT_WHOLE, OUT_OF_RANGE = "missing", "unreadable", "not whole", "out of range"
_WHOLE = r"^[+-]?[0-9]+$"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _reasons(field: T.StructField) -> list[str]:
    """All reasons that a column's cells can be rejected for."""
    kind = field.dataType
    reasons = [] if isinstance(kind, T.StringType) else [UNREADABLE]
    if isinstance(kind, (*_INTEGERS, T.DecimalType)):
        reasons.append(OUT_OF_RANGE)
    if isinstance(kind, _INTEGERS):
        reasons.append(NOT_WHOLE)
    return reasons if field.nullable else [*reasons, MISSING]


def _reason(text: Column, kind: T.DataType) -> Column:
    """Why a text that is not null gave no value of that type."""
    plain = F.trim(text)
    if isinstance(kind, _INTEGERS):
        return F.when(plain.rlike(_WHOLE), OUT_OF_RANGE).when(plain.rlike(NUMBER), NOT_WHOLE).otherwise(UNREADABLE)
    if isinstance(kind, T.DecimalType):
        return F.when(plain.rlike(NUMBER), OUT_OF_RANGE).otherwise(UNREADABLE)
    return F.lit(UNREADABLE)


def _quarantined(field: T.StructField, name: str | None, source: T.DataType | None) -> list[Column]:
    """The reject of a column's cell; null where the cell fits. No column if no cell of it can be rejected."""
    def cell(reason: Column, text: Column) -> Column:
        return F.struct(F.lit(field.name).alias("column"), reason.alias("reason"), text.cast("string").alias("cell"))

    if name is None:
        return [] if field.nullable else [cell(F.lit(MISSING), F.lit(None))]
    raw = F.col(f"`{name}`")
    checks = []
    if source != field.dataType and not isinstance(field.dataType, T.StringType):
        lost = raw.isNotNull() & raw.try_cast(field.dataType).isNull()
        checks.append(F.when(lost, cell(_reason(raw.cast("string"), field.dataType), raw)))
    if not field.nullable:
        checks.append(F.when(raw.isNull(), cell(F.lit(MISSING), raw)))
    return [F.coalesce(*checks)] if checks else []


def conform_keeping_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``conform`` and ``_rejects``: per row the cells that are not in it, as (column, reason, cell).

    A blank or unreadable cell of a column that may be null is null in both; the unreadable one is a reject. A null in a
    column declared ``NOT NULL``, or the lack of that column, is a reject too (``missing``); the row stays. Decimals
    that have more places than their type are rounded, which is no reject. Columns the schema does not know go.
    """
    present = {name.lower(): name for name in df.columns}
    cells = []
    for field in schema:
        name = present.get(field.name.lower())
        cells += _quarantined(field, name, None if name is None else df.schema[name].dataType)
    rejects = F.array_compact(F.array(*cells)).cast(_CELL) if cells else F.array().cast(_CELL)
    kept = "_kept"
    while kept in present:
        kept += "_"
    # the rejects travel beside the raw row, so that both come from the same scan
    named = df.withColumn(kept, rejects)
    conformed = conform(named, T.StructType([*schema, T.StructField(kept, rejects_type())]))
    return conformed.withColumnRenamed(kept, REJECTS)


def rejects_type() -> T.DataType:
    return T.DataType.fromDDL(_CELL)


def quarantine(conformed: DataFrame, *keep: str) -> DataFrame:
    """One row per rejected cell: the columns to ``keep``, column, reason, cell."""
    return conformed.select(*keep, F.inline(REJECTS))


def reject_counts(conformed: DataFrame) -> DataFrame:
    """How many cells were rejected, by column and reason; combined on the map side."""
    return quarantine(conformed).groupBy("column", "reason").agg(F.count("*").alias("cells"))


def conform_job(df: DataFrame, schema: T.StructType, path: str, mode: str = "overwrite") -> dict[tuple[str, str], int]:
    """Writes the conformed rows with their rejects and returns the counts by column and reason, observed in the write."""
    conformed = conform_keeping_rejects(df, schema)
    observed = Observation("rejects")
    names = [(field.name, reason) for field in schema for reason in _reasons(field)]

    def count(column: str, reason: str) -> Column:
        is_it = F.exists(REJECTS, lambda r: (r["column"] == column) & (r["reason"] == reason))
        return F.count_if(is_it)

    counts = [count(*name).alias(f"c{i}") for i, name in enumerate(names)]
    write_parquet(conformed.observe(observed, F.count(F.lit(1)).alias("rows"), *counts), path, mode)
    got = observed.get
    return {name: got[f"c{i}"] for i, name in enumerate(names) if got[f"c{i}"]}


def read_conformed(spark: SparkSession, path: str) -> DataFrame:
    """The conformed rows that ``conform_job`` wrote; the rejects are not read."""
    return spark.read.parquet(path).drop(REJECTS)


def read_quarantine(spark: SparkSession, path: str, *keep: str) -> DataFrame:
    """The rejected cells; only their column, and those to ``keep``, are read."""
    return quarantine(spark.read.parquet(path), *keep)
