"""A caller's columns that are named like an operator's helpers come back as they were."""
from __future__ import annotations

import pytest

from punctual.llm import decontaminate, near_dedup, quality_rules, secret_scan

NAMES = ["__hash", "__salt", "__id", "__th", "__blob", "__text", "__spans", "__copy", "__n"]
WORDS = "one good plain text about the quick brown fox that jumps over many lazy dogs in the warm evening sun".split()


@pytest.mark.parametrize("name", ["keep_good", "drop_matches", "redact", "keep_one"])
def test_helper_names_are_free(spark, name):
    text = " ".join(WORDS)
    rows = [(1, text), (2, text + " password=abcdefgh1 end"), (3, "an item of the benchmark stands in here, too"), (4, " ".join(reversed(WORDS)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for i, c in enumerate(NAMES):
        docs = docs.selectExpr("*", f"cast({i} as int) AS `{c}`")
    items = spark.createDataFrame([(1, "an item of the benchmark stands in here")], "item_id long, text string")
    run = {"keep_good": lambda d: quality_rules.keep_good(spark, d), "drop_matches": lambda d: decontaminate.drop_matches(spark, d, items),
           "redact": lambda d: secret_scan.redact(spark, d, secret_scan.new_ledger(spark)), "keep_one": lambda d: near_dedup.keep_one(spark, d, size=5, percent=80)}[name]
    plain = sorted(tuple(r) for r in run(docs.select("doc_id", "text")).collect())
    out = run(docs)
    assert out.columns == docs.columns and plain
    assert sorted(tuple(r) for r in out.collect()) == [(*r, *range(len(NAMES))) for r in plain]
