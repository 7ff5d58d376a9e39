"""Corpus pipeline: the training-data operators applied one after another.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs.  ``run`` does that over ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from routelytics.llm import byte_bpe, decontaminate, near_dedup, pii, quality_rules
from routelytics.session import RoundTables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with placeholders for personal data."""
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of their decoding."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", dedup),
    ("decontaminate", decontaminated),
    ("pii", redacted),
    ("byte_bpe", encoded),
]

#: SQL cannot express the fitted estimates and token ids; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = RoundTables(spark, "pipeline")
    for _, stage in STAGES:
        docs, _ = tables.write(stage(spark, docs, sf_dir))
    return docs
