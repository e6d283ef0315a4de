"""Results that readers see whole: the last one or the next one, never a part.

    <path>/versions/<name>       parquet, written in full first
    <path>/published/<number>    a file that names a version; the highest number counts

A write goes to a version of its own name. Only when it is complete does a file that names it appear, by a rename to a
name that must not exist yet, so of two writers with the same number one fails and its version is never seen. A write that
fails leaves the published result as it was. The folder's file system has to rename files atomically.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from daybook.sources.writers import write_snapshot


class Folder:
    """The files of a published result, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self._jvm = path.rstrip("/"), spark._jvm
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [status.getPath().getName() for status in self._files.listStatus(at)] if self._files.exists(at) else []

    def numbers(self) -> list[int]:
        return sorted(int(name) for name in self.names("published") if name.isdecimal())

    def version(self, number: int) -> str:
        stream = self._files.open(self._at(f"published/{number:012d}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def name(self, number: int, version: str) -> None:
        """Publishes a version under a number; fails if the number is taken."""
        draft, final = self._at(f"drafts/{version}"), self._at(f"published/{number:012d}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(version.encode()))
        finally:
            stream.close()
        self._files.mkdirs(final.getParent())
        try:
            is_ours = not self._files.exists(final) and self._files.rename(draft, final)
        except Py4JJavaError as taken:
            raise PublishedMeanwhile(f"{self.path}: {number}") from taken
        if not is_ours:
            raise PublishedMeanwhile(f"{self.path}: {number}")

    def remove(self, name: str) -> None:
        self._files.delete(self._at(name), True)


class PublishedMeanwhile(RuntimeError):
    """Another writer published first; nothing of ours is seen."""


def publish(df: DataFrame, path: str, keep: int = 2) -> int:
    """Writes the frame as a new version, publishes it and returns its number of rows.

    The last ``keep`` published results stay for those who still read them; older ones go. ``df`` may read the
    result that is published now.
    """
    if keep < 1:
        raise ValueError("keep at least the result that is published")
    folder = Folder(df.sparkSession, path)
    number = max(folder.numbers(), default=-1) + 1
    version = uuid.uuid4().hex
    try:
        rows = write_snapshot(df, f"{folder.path}/versions/{version}", mode="error")
        folder.name(number, version)
    except Exception:
        folder.remove(f"versions/{version}")
        folder.remove(f"drafts/{version}")
        raise
    for old in folder.numbers()[:-keep]:
        gone = folder.version(old)
        folder.remove(f"published/{old:012d}")
        folder.remove(f"versions/{gone}")
    return rows


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The published result, or an earlier one that is still kept."""
    folder = Folder(spark, path)
    if number is None:
        numbers = folder.numbers()
        if not numbers:
            raise FileNotFoundError(f"nothing is published below {path}")
        number = numbers[-1]
    return spark.read.parquet(f"{folder.path}/versions/{folder.version(number)}")
