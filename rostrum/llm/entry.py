"""Queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm import bpe, decontaminate, hamming, jaccard_join, line_dedup, pii, suffix_dedup, token_files, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read(files)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("cleaned_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(_table(spark, sf_dir, "pages"))).drop("url")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(_table(spark, sf_dir, "documents")))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS target FROM pages),
q AS (
  SELECT page_id, target, strlen(html) AS payload_bytes, sha1(html) AS h FROM p
), bits AS (
  SELECT page_id, target, payload_bytes, list_aggregate(list_transform(range(0, 40), lambda i: lpad(bin(('0x' || h[i + 1])::INTEGER), 4, '0')), 'string_agg', '') AS b FROM q
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(0, 5), lambda j: CASE WHEN b[5 * i + j + 1] = '1' THEN 16 >> j ELSE 0 END))::INTEGER]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> target THEN target END AS refers_to
FROM bits
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_toxicity, op3_exact_top_k, op4_benchmark_decontamination, op5_token_files, op6_suffix_dedup, op7_line_dedup, op8_warc, op9_bpe_round_trip, op10_pii)}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_top_k": hamming.SQL, "op7_line_dedup": line_dedup.SQL, "op8_warc": WARC_SQL}
