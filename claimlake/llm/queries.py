"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, lm_scoring, near_dedup, packing, perplexity, pii, quality_rules, shards, token_counts, topk, toxicity, vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), n=2, percent=80)


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_perplexity": op2_perplexity,
    "op3_pii": op3_pii,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_bpe": op7_bpe,
    "op8_topk": op8_topk,
    "op9_near_dedup": op9_near_dedup,
    "op10_shards": op10_shards,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_vector_codes": op12_vector_codes,
    "op13_divergence": op13_divergence,
}
ORACLE_SQL: dict[str, str] = {
    "op12_vector_codes": vector_codes.ORACLE_SQL,
    "op13_divergence": divergence.ORACLE_SQL,
    "op8_topk": """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
}
