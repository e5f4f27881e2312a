"""A training-corpus pipeline over `documents`: each stage calls one operator of
punctual.llm, is written as Parquet in the shared folder and read again by the next.

Stages work on all rows their predecessor kept. Documents that the quality
rules reject, all but one of each group of near duplicates (five-word shingles,
similarity 0.8) and documents that hold a benchmark item go; secrets are cut out
of the texts; what is left is encoded. Null texts are empty texts (and go with
the quality rules), null ids are ids like any others, repeated rows are near
duplicates of each other, an empty table stays empty, further columns are kept
up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctual.llm import bpe, decontaminate, near_dedup, quality_rules, secret_scan
from punctual.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of being good is at least 1/2."""
    return quality_rules.keep_good(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(spark, docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.drop_matches(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secret_scan.redact(spark, docs, secret_scan.new_ledger(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and digests of the ids and of what they decode to."""
    content, pattern = bpe.public_vocabulary()
    return bpe.encode_decode(docs, content, pattern, full=True).drop("decoded")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("bpe encoding", encoding),
]

#: SQL can't express the estimation, the hashing or the merges; tests/llm holds
#: the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
