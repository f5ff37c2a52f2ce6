"""From documents to packed sequences: toxicity, quality, near-duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storyloom.llm import neardup, packing, quality, secret_scan, toxicity
from storyloom.llm.common import Scratch, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(spark, docs, sf_dir)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(spark, docs, sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(spark, docs, sf_dir)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(spark, docs, sf_dir)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(spark, docs, sf_dir)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: Trained models and tokenizers can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
