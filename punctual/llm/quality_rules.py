"""Quality rules combined by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) from whole-text statistics.
The number of documents with each vote pattern is all that expectation-
maximisation needs: it estimates, without labels, the share of good documents
and of each kind of bad ones and how accurately each rule votes on them (rules
that agree on one kind of junk don't outvote another), and the posterior probability
that a document is good replaces all-must-pass filtering. With R rules there
are at most 3^R patterns (R is a few; checked), so the pattern table is small
at any input size. The main path is DataFrame functions only.

Defined results: a null or empty text has no words, so the base rule fails and
it is not kept; repeated rows give repeated rows; an empty table gives an empty
result; columns other than the key and the text are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import materialize, sheltered
from punctual.llm.text_stats import with_stats

MAX_RULES = 9  # 3^9 = 19,683 patterns at most


@dataclass(frozen=True)
class VoteRule:
    """Votes bad where the SQL condition ``bad`` holds, else good where ``good``
    does; abstains otherwise (and where a condition is null). ``kind`` names the
    sort of bad document that the rule is about."""

    name: str
    kind: str
    bad: str = "false"
    good: str = "false"

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0).cast("int")


_WORDS = "greatest(n_words, 1)"
RULES = (
    VoteRule("symbols", "symbols", bad=f"n_symbols > 0.1 * {_WORDS}", good=f"n_symbols <= 0.02 * {_WORDS}"),
    VoteRule("many_symbols", "symbols", bad=f"n_symbols > 0.3 * {_WORDS}"),
    VoteRule("repeats", "repetition", bad=f"n_repeat_words > 0.2 * {_WORDS}", good="n_repeat_words = 0"),
    VoteRule("dup_lines", "repetition", bad="n_lines > 2 and n_dup_lines > 0.4 * n_lines"),
    VoteRule("capitals", "shouting", bad="n_upper > 0.4 * greatest(word_chars, 1)"),
    VoteRule("punctuation", "shouting", bad=f"n_punct > {_WORDS}"),
    VoteRule("word_length", "shape", bad=f"word_chars > 12 * {_WORDS} or word_chars < 2 * {_WORDS}", good=f"word_chars between 3 * {_WORDS} and 7 * {_WORDS}"),
    VoteRule("prose", "shape", good=f"n_words >= 50 and n_punct between 0.05 * {_WORDS} and 0.4 * {_WORDS}"),
)

#: where the estimation begins, as P(bad vote, abstains, good vote) of a rule: on
#: good documents, on bad ones of the rule's own kind and of another kind
START = {"good": (0.01, 0.44, 0.55), "own": (0.6, 0.3, 0.1), "other": (0.05, 0.5, 0.45)}


@dataclass(frozen=True)
class Model:
    """Documents are good or of one of the kinds of bad ones; given that, the
    rules vote independently."""

    kinds: tuple[str, ...]                # "good" and the kinds of bad documents
    share: tuple[float, ...]              # of documents, by kind
    #: per rule and kind: P(vote), in the order bad, abstains, good
    chances: tuple[tuple[tuple[float, float, float], ...], ...]

    def log_weights(self, votes: tuple[int, ...]) -> list[float]:
        return [math.log(s) + sum(math.log(c[k][v + 1]) for v, c in zip(votes, self.chances))
                for k, s in enumerate(self.share)]

    def posterior(self, votes: tuple[int, ...]) -> list[float]:
        w = self.log_weights(votes)
        e = [math.exp(x - max(w)) for x in w]
        return [x / sum(e) for x in e]

    def accuracy(self, rule: int) -> float:
        """P(the rule is right | it votes)."""
        c = self.chances[rule]
        right = self.share[0] * c[0][2] + sum(s * x[0] for s, x in zip(self.share[1:], c[1:]))
        return right / sum(s * (x[0] + x[2]) for s, x in zip(self.share, c))


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: tuple[VoteRule, ...] = RULES, rounds: int = 300,
        good: float = 0.85, weight: float = 2.0) -> Model:
    """Expectation-maximisation over (votes, documents) counts. ``weight``
    pseudo-documents of the starting model keep every estimate off 0 and 1."""
    kinds = ("good", *dict.fromkeys(r.kind for r in rules))
    first = (good, *((1 - good) / (len(kinds) - 1),) * (len(kinds) - 1))
    begin = tuple(tuple(START["good" if k == "good" else "own" if k == r.kind else "other"] for k in kinds) for r in rules)
    model = Model(kinds, first, begin)
    for _ in range(rounds):
        docs = [weight * s for s in first]
        seen = [[[weight * x for x in c] for c in row] for row in begin]
        for votes, n in patterns:
            for k, p in enumerate(model.posterior(votes)):
                docs[k] += n * p
                for j, v in enumerate(votes):
                    seen[j][k][v + 1] += n * p
        new = Model(kinds, tuple(d / sum(docs) for d in docs),
                    tuple(tuple(tuple(x / sum(c) for x in c) for c in row) for row in seen))
        done = max(abs(a - b) for a, b in zip(new.share, model.share)) < 1e-9
        model = new
        if done:
            break
    return model


def posterior(model: Model, votes: list[str]) -> Column:
    """P(good) of a document from its vote columns."""
    against = F.lit(0.0)
    for k in range(1, len(model.kinds)):
        total = F.lit(math.log(model.share[k] / model.share[0]))
        for name, c in zip(votes, model.chances):
            odds = [math.log(b / g) for b, g in zip(c[k], c[0])]
            total = total + F.when(F.col(name) < 0, odds[0]).when(F.col(name) > 0, odds[2]).otherwise(odds[1])
        against = against + F.exp(total)
    return F.lit(1.0) / (F.lit(1.0) + against)


def judge(spark: SparkSession, docs: DataFrame, keys: list[str], text: str = "text",
          rules: tuple[VoteRule, ...] = RULES, threshold: float = 0.5) -> tuple[DataFrame, Model]:
    """``keys``, the text statistics, a ``vote_*`` column per rule, ``p_good``,
    ``base_failed`` and ``kept`` for every row of ``docs``; and the model."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} keep the pattern table small")
    votes = [f"vote_{r.name}" for r in rules]
    seen = with_stats(docs, keys, text)
    seen = materialize(spark, seen.select("*", *[r.vote().alias(v) for r, v in zip(rules, votes)]), "votes")
    counts = seen.groupBy(*votes).count().collect()  # at most 3^rules rows
    model = fit(sorted((tuple(row[v] for v in votes), row["count"]) for row in counts), rules)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    out = seen.withColumns({"p_good": posterior(model, votes), "base_failed": failed})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)), model


def verdicts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out, _ = judge(spark, docs, ["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "p_good")


@sheltered
def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept; all columns."""
    judged, _ = judge(spark, docs.withColumn("__hash", F.xxhash64("text")), ["doc_id", "__hash"])
    good = judged.where("kept").select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__th")).distinct()
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th"))
    return rows.join(good.hint("shuffle_hash"), on, "left_semi").select(*docs.columns)
