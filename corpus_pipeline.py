"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared scratch folder and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barwise.llm import bpe, decontamination, neardup, quality_rules, secrets
from barwise.llm.scratch import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more)."""
    return neardup.drop_copies(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays."""
    return secrets.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return bpe.digests(docs, with_ids=True)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminate),
          ("secrets", mask_secrets), ("byte_bpe", tokenize)]

# The outlier estimates, likelihood bands and merges are no SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
