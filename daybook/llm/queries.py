"""The registered queries of the numbered operators and the pipeline, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, decontaminate, interaction, license, lm, negatives, neighbours, pii, quality, secrets, simhash, token_files, topk
from daybook.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judged(quality.scores(docs, net))


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.summary(license.scan(documents(spark, sf_dir)))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(spark, documents(spark, sf_dir), bpe.default_path())


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_ids(documents(spark, sf_dir))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pii.digests(pii.spans(docs))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.judged(decontaminate.hits(documents(spark, sf_dir), benchmark))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(documents(spark, sf_dir), bpe.default_path()))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scanned(spark, documents(spark, sf_dir)))


def op11_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_license": op2_license,
    "op3_token_files": op3_token_files,
    "op4_simhash": op4_simhash,
    "op5_lm": op5_lm,
    "op6_pii": op6_pii,
    "op7_decontaminate": op7_decontaminate,
    "op8_topk": op8_topk,
    "op9_bpe": op9_bpe,
    "op10_secrets": op10_secrets,
    "op11_interaction": op11_interaction,
    "op12_neighbours": op12_neighbours,
    "op13_negatives": op13_negatives,
}

OP8_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP11_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), failed AS (
    SELECT part, doc_id,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
    FROM texts
), flagged AS (
    SELECT part, fails, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
           doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
    FROM failed
), counted AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM flagged GROUP BY 1, 2
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), orders AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), outcomes AS (
    SELECT *, contains(fails, own) AS fails_own, earlier <> '' AND regexp_matches(fails, '[' || earlier || 'x]') AS gone
    FROM counted, steps
), report AS (
    SELECT part, filter_order, step, own,
           CAST(coalesce(sum(n) FILTER (NOT fails_own AND NOT gone), 0) AS BIGINT) AS kept,
           CAST(coalesce(sum(n) FILTER (fails_own AND NOT gone), 0) AS BIGINT) AS removed,
           CAST(coalesce(sum(n) FILTER (fails_own AND gone), 0) AS BIGINT) AS redundant,
           CAST(coalesce(sum(n) FILTER (fails = own), 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(sum(good) FILTER (fails_own AND NOT gone), 0) AS BIGINT) AS good_lost,
           CAST(coalesce(sum(toxic) FILTER (fails_own AND NOT gone), 0) AS BIGINT) AS toxic_lost
    FROM outcomes GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM report
"""

OP13_SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLES: dict[str, str] = {"op8_topk": OP8_SQL, "op11_interaction": OP11_SQL, "op13_negatives": OP13_SQL}
