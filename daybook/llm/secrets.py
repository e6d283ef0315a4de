"""Secret scans over all versions of all files, by an incremental ledger of blobs.

Every version's content is addressed by its SHA-256. The ledger is a table of the blobs scanned, one row per
blob and version of the rules, with the spans found. An update scans only the pairs that the ledger lacks, each
blob once however many paths and versions hold it, appends them, and joins the findings back to all rows.

Scale: contents are made distinct with a combination on the map side, so copies of one blob do not gather in a
task; findings are joined back as narrow rows (Spark splits a hot blob's partition), only blobs with findings.
The ledger's rows are written before they are read, so lost executors cost recomputation only.

Defined cases: null and empty texts are the empty blob, without findings. Every row of the table gets its
own row in the result, repeated or not. An empty table scans nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import col, fresh, map_arrow, scratch, slices

#: Kind, pattern, the group whose length counts, its least length, and a text without which nothing matches.
#: The first three are the base rules; the others are formats of well-known issuers.
RULES = [
    ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6,
     ("passw", "secret", "token", "key")),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    ("hex", r"[0-9a-f]{24,}", 0, 24, ()),
    ("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:[^-]*-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?", 0, 1, ("private key",)),
    ("code_host", r"(?:gh[pousr]_|github_pat_|glpat-)[A-Za-z0-9_-]{20,}", 0, 1, ("gh", "glpat-")),
    ("chat", r"xox[abeprs]-[A-Za-z0-9-]{10,}", 0, 1, ("xox",)),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", 0, 1, ("eyj",)),
    ("payment", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 1, ("k_live_",)),
    ("maps", r"AIza[A-Za-z0-9_-]{35}", 0, 1, ("aiza",)),
    ("address", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{3,100}@[A-Za-z0-9.-]+", 0, 1, ("://",)),
]
BASE = ("assign", "access", "hex")
SPANS = "array<struct<kind: string, start: int, stop: int>>"
COMPILED = [(kind, re.compile(rule), group, least, cues) for kind, rule, group, least, cues in RULES]


def rule_version() -> str:
    return hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (code points), by start, then kind as listed; a match that is too short is dropped, not retried."""
    lower, found = text.lower(), []
    for place, (kind, rule, group, least, cues) in enumerate(COMPILED):
        if not cues or any(c in lower for c in cues):
            found += [(m.start(), place, kind, m.end()) for m in rule.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def scan(blobs: DataFrame) -> DataFrame:
    """blob and its spans, from blob and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in slices(batches):
            spans = [[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in find(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(spans, kind)], ["blob", "spans"])

    return map_arrow(blobs, run, f"blob binary, spans {SPANS}")


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger in the folder; empty if it has none yet."""
    schema = f"blob binary, spans {SPANS}, rule_version string"
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def update(versions: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """Scans the blobs of `versions` that the ledger in `folder` lacks, appends them, and gives the new rows."""
    spark, version = versions.sparkSession, rule_version()
    contents = versions.select(address(col(text)).alias("blob"), F.coalesce(col(text), F.lit("")).alias("text"))
    known = ledger(spark, folder).where(F.col("rule_version") == version).select("blob")
    unseen = contents.dropDuplicates(["blob"]).join(known, "blob", "left_anti")
    scan(unseen).withColumn("rule_version", F.lit(version)).write.mode("append").parquet(folder)
    return ledger(spark, folder)


def findings(versions: DataFrame, folder: str, text: str = "text", name: str = "spans") -> DataFrame:
    """All rows and columns of `versions` but the text, with the spans of their content from the ledger."""
    blob, spans = fresh("blob", versions.columns), fresh(name, versions.columns)
    found = ledger(versions.sparkSession, folder).where((F.col("rule_version") == rule_version()) & (F.size("spans") > 0))
    found = found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
    rows = versions.withColumn(blob, address(col(text))).drop(text)
    none = F.array().cast(SPANS)
    return rows.join(found, blob, "left").withColumn(spans, F.coalesce(col(spans), none)).drop(blob)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of doc_id and spans."""
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    return found.select(
        "doc_id",
        *[count(F.col("spans"), kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def scanned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id and spans of all documents, through a ledger of their own that begins empty."""
    folder = f"{scratch(spark, 'ledger')}/blobs"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    update(rows, folder)
    return findings(rows, folder)
