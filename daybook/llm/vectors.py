"""What the vector searches share: the rows that take part, query blocks in the shared folder, exact products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.sources.scratch import scratch


def finite(vector: str) -> Column:
    """Whether a vector is there, has components, and all of them are numbers."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def padded(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """The lists as a matrix; shorter ones have zeros at the end, which change no inner product."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def stored(rows: DataFrame, name: str) -> str:
    """The rows as Parquet files in the shared folder, for tasks to read a block at a time; their path."""
    path = f"{scratch(rows.sparkSession, name)}/rows"
    rows.write.parquet(path)
    return path


def blocks(path: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows that `stored` wrote, at most `size` at a time, in the same order for every reader."""
    from pyarrow import fs
    from pyarrow import parquet

    system, place = fs.FileSystem.from_uri(path)
    files = system.get_file_info(fs.FileSelector(place))
    for file in sorted(f.path for f in files if f.path.endswith(".parquet")):
        with system.open_input_file(file) as source:
            yield from parquet.ParquetFile(source).iter_batches(size)


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row inner products, added up in the order of the components: equal vectors give equal bits anywhere."""
    total = np.zeros(len(left), np.float64)
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total
