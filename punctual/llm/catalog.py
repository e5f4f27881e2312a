"""Registered queries of this folder: thin wrappers that give each operator its
whole table and production parameters, and the DuckDB SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import (decontaminate, hard_negatives, language_id, lm_scoring, near_dedup, periodic_runs, quality_rules, repeat_spans,
                          rule_ensemble, secret_scan, url_filter)
from punctual.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f
    return add


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from punctual.llm import bpe

    content, pattern = bpe.public_vocabulary()
    return bpe.encode_decode(table(spark, sf_dir, "documents"), content, pattern)


@query("op1_secret_scan", secret_scan.ORACLE)
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(spark, table(spark, sf_dir, "documents"), secret_scan.new_ledger(spark))


@query("op2_near_dedup")
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(spark, table(spark, sf_dir, "documents"))


@query("op4_repeat_spans")
def op4_repeat_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_spans.remove_repeats(spark, table(spark, sf_dir, "documents"), keep_first=False, full=False)


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matches(spark, docs, items, ["doc_id"])


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1)


@query("op7_lm_scoring")
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(spark, table(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


@query("op8_rule_ensemble")
def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return rule_ensemble.classify(spark, docs, labels, fold("doc_id", 3) == 1)[0]


@query("op10_url_filter", url_filter.ORACLE)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return url_filter.judge(spark, pages, url_filter.labelled_pages(pages, labels), ["page_id"]).drop("low")


@query("op11_rank_bpe")
def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from punctual.llm import rank_bpe

    content, pattern = rank_bpe.public_ranks()
    return rank_bpe.encode_decode(table(spark, sf_dir, "documents"), content, pattern)


@query("op12_hard_negatives", hard_negatives.ORACLE)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id"), hard_negatives.moved_label(),
                               F.col("embedding"), F.col("vec_id") % 50 == 0)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.looped(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.detect(docs))
