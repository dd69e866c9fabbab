"""The corpus pipeline: toxicity, quality rules, near-duplicates, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import near_dedup, packing, pii, quality_rules, toxicity
from claimlake.llm.shared import stored


#: Rows to drop up to which their numbers are broadcast; joined by hash beyond.
BROADCAST_ROWS = 5_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a toxicity score under 0.5. Null and empty texts stay; a repeated doc_id is judged row by row."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep. Null and empty texts go (under 50 words); a repeated doc_id is judged row by row."""
    return quality_rules.passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five-word shingles, similarity 0.8 or more.

    Rows are told apart by their number in the stored table that a stage reads, so repeated rows, repeated and null
    ids are duplicates like any other; the first row stays. Null and empty texts are linked with nothing and stay.
    """
    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    verdicts = near_dedup.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), n=5, percent=80)
    gone = stored(verdicts.filter("NOT kept").select(F.col("doc_id").alias("__row")), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "__row", "left_anti").select(docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind; n_chars follows, 0 for a null text."""
    return pii.redact(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences: every row's ids, null and empty texts the end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_repetitive), ("near_dedup", drop_near_duplicates), ("pii", redact_pii), ("packing", pack)]
#: Scores, verdicts and merges are beyond SQL; the stages' operators are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
