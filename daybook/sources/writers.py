"""Where results go. Paths always come from the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from daybook.functions.headers import as_text


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_text_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet with every column as text."""
    write_parquet(as_text(df), path, mode)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of csv files, each with a header row.

    Nulls and empty texts are both empty cells, blanks around a text are kept, and a quote inside a
    text is doubled.
    """
    options = {
        "header": True, "emptyValue": "", "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    df.write.mode(mode).options(**options).csv(path)


def write_snapshot(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> int:
    """Writes parquet and returns the number of rows, counted during the write itself."""
    observed = Observation("snapshot")
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    write_parquet(counted, path, mode, partition_by)
    return observed.get["rows"]
