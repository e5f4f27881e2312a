"""Quality classifier: a sparse rule ensemble over text statistics.

Small trees are boosted on a bounded sample of labelled rows, drawn by hash
(``max_rows``); every path of a tree is a conjunctive rule ("symbols per word
above a and distinct words below b"). A lasso logistic model keeps the few rules
that matter, and the rules compile into one Spark column expression, so scoring
all documents runs no Python. The statistics of whole texts are computed once
and written to the shared folder, for the fit and for the scores.

Defined results: a null or empty text has all statistics 0 and is scored like
any other; without labelled rows every score is 0.5, with labels of one kind it
is their share; a document labelled more than once counts once, as 0 if any
label is 0; null labels are not labels; repeated documents get the same score
each; no other column is read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import materialize
from punctual.llm.text_stats import with_stats

#: feature -> SQL expression over the text statistics
FEATURES = {
    "words": "log(n_words + 1.0)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "capitals": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "punctuation": "n_punct / greatest(n_words, 1)",
    "variety": "n_distinct / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "line_words": "log(n_words / greatest(n_lines, 1) + 1.0)",
}

Condition = tuple[int, bool, float]  # feature, above (else at most), threshold
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Ensemble:
    features: tuple[str, ...]
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """P(label 1) from the feature columns."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            met = F.lit(True)
            for f, above, t in rule:
                c = F.col(self.features[f])
                met = met & ((c > t) if above else (c <= t))
            total = total + F.when(met, weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = self.bias + (truth(x, [r for r, _ in self.rules]) @ np.array([w for _, w in self.rules]) if self.rules else np.zeros(len(x)))
        return 1 / (1 + np.exp(-total))


def truth(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, j] *= (x[:, f] > t) == above
    return out


def grow(bins: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, depth: int, least: int) -> list[tuple[Rule, np.ndarray, float]]:
    """A regression tree as (path, rows, value) of all its nodes but the root."""
    out: list[tuple[Rule, np.ndarray, float]] = []

    def split(path: Rule, rows: np.ndarray, level: int) -> None:
        best = (1e-9, 0, 0)
        r = residual[rows]
        total, n = r.sum(), len(rows)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            count = np.cumsum(np.bincount(bins[rows, f], minlength=len(cut) + 1))[:-1]
            left = np.cumsum(np.bincount(bins[rows, f], r, len(cut) + 1))[:-1]
            ok = (count >= least) & (n - count >= least)
            if ok.any():
                gain = np.where(ok, left ** 2 / np.maximum(count, 1) + (total - left) ** 2 / np.maximum(n - count, 1) - total ** 2 / n, 0)
                if gain.max() > best[0]:
                    best = (float(gain.max()), f, int(gain.argmax()))
        if best[0] <= 1e-9:
            return
        _, f, k = best
        for above in (False, True):
            part = rows[(bins[rows, f] > k) == above]
            node = (*path, (f, above, float(cuts[f][k])))
            out.append((node, part, float(residual[part].mean())))
            if level > 1:
                split(node, part, level - 1)

    split((), np.arange(len(residual)), depth)
    return out


def simplify(rule: Rule) -> Rule:
    """The rule with the tightest threshold per feature and side, in order."""
    tight: dict[tuple[int, bool], float] = {}
    for f, above, t in rule:
        known = tight.get((f, above))
        tight[f, above] = t if known is None else max(known, t) if above else min(known, t)
    return tuple((f, above, t) for (f, above), t in sorted(tight.items()))


def fit(x: np.ndarray, y: np.ndarray, features: tuple[str, ...] = tuple(FEATURES), trees: int = 24, depth: int = 3,
        rate: float = 0.3, penalty: float = 1e-3, steps: int = 400, max_cuts: int = 63) -> Ensemble:
    if not len(y):
        return Ensemble(features, 0.0, ())
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    if y.min() == y.max():
        return Ensemble(features, base, ())
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, max_cuts + 2)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)  # bin > k: value above cuts[k]
    logit, rules = np.full(len(y), base), {}
    for _ in range(trees):
        nodes = grow(bins, cuts, y - 1 / (1 + np.exp(-logit)), depth, max(5, len(y) // 500))
        deepest = {id(rows): (rows, v) for path, rows, v in nodes if not any(len(p) > len(path) and p[:len(path)] == path for p, _, _ in nodes)}
        for rows, v in deepest.values():
            logit[rows] += rate * 4 * v
        for path, _, _ in nodes:
            rules.setdefault(simplify(path))
    if not rules:
        return Ensemble(features, base, ())
    rules = list(rules)
    return lasso(truth(x, rules), y, rules, features, base, penalty, steps)


def lasso(z: np.ndarray, y: np.ndarray, rules: list[Rule], features: tuple[str, ...], base: float, penalty: float, steps: int) -> Ensemble:
    """L1-penalised logistic weights by accelerated proximal gradient steps."""
    mean = z.mean(axis=0)
    z = z - mean
    step = 4 * len(y) / np.linalg.norm(z.T @ z + np.eye(z.shape[1]), 2)
    w, b, ahead, t = np.zeros(z.shape[1]), base, np.zeros(z.shape[1]), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead + b, -50, 50)))
        b -= (p - y).mean() * 4
        new = ahead - step * (z.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / after * (new - w), new, after
    kept = [(r, float(v)) for r, v in zip(rules, w) if v != 0]
    return Ensemble(features, float(b - mean @ w), tuple(kept))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text",
             label: str = "quality", max_rows: int = 20_000) -> tuple[DataFrame, Ensemble]:
    """(key, held_out, score, predicted of every row of ``docs``; the model),
    learnt from labels of rows that aren't held out."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    stats = with_stats(docs, ["doc_id", "held_out"])
    x = materialize(spark, stats.select("doc_id", "held_out", *[F.expr(e).cast("double").alias(f) for f, e in FEATURES.items()]), "features")
    known = (labels.select(F.col(key).alias("doc_id"), F.col(label).cast("double").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    rows = x.where("NOT held_out").join(known, "doc_id").dropDuplicates(["doc_id"])
    share = min(1.0, 0.95 * max_rows / max(1, rows.count()))  # by hash, so about 0.95 * max_rows rows
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = sorted(tuple(r) for r in rows.select(*FEATURES, "y").collect())
    rows = np.array([list(r) for r in sample], float).reshape(len(sample), len(FEATURES) + 1)
    model = fit(rows[:, :-1], rows[:, -1])
    scored = x.select(F.col("doc_id").alias(key), "held_out", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), model
