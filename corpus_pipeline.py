"""The corpus pipeline: each stage takes (spark, docs, sf_dir), its result is written and read as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import bpe, decontaminate, pii, quality, simhash
from daybook.llm.common import documents, settle


def accepted_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels, rejects go."""
    return quality.accept(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id, stays."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by placeholders; n_chars follows."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token digests of every document left."""
    return bpe.digests(bpe.encode_decode(docs, bpe.default_path()))


STAGES = [
    ("quality", accepted_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", tokens),
]

#: No stage but the last text functions is within reach of SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
