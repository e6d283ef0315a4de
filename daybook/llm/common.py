"""What the operators share: scratch tables in the shared folder, names, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.scratch import scratch

#: Bytes of text that a Python task works on at a time.
SLICE_BYTES = 4 << 20
SHIPPED: set[str] = set()


def settle(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a written table: cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{scratch(spark, name)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: Iterable[str]) -> str:
    """`name`, with underscores until it clashes with no column (Spark compares without case)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def col(name: str):
    """The top-level column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only doc_id (as long) and text (null: empty), so that no other column can clash or be read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="daybook-")) / "daybook.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` whose function may come from this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `size` bytes of the column (or one longer row)."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts in UTF-8; null: empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
