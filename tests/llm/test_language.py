"""Language identification against plain recursion, whole training and predictions."""
from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import language_id
from punctual.llm.language_id import MARK, Pieces, expected, log_forward, word_logs

PIECES = ["a", "ab", "aba", "b", "ba", "c", MARK, MARK + "a", MARK + "ab"]
SIZE = len(PIECES)


def splits(word):
    """All segmentations of a word, as lists of piece ids."""
    if not word:
        return [[]]
    out = []
    for n in range(1, min(3, len(word)) + 1):
        p = word[:n]
        if p in PIECES or n == 1:
            out += [[PIECES.index(p) if p in PIECES else SIZE, *rest] for rest in splits(word[n:])]
    return out


def brute_model(rows, rounds=2, smooth=0.1):
    languages = sorted({k for _, k in rows})
    prob = {k: [1 / (SIZE + 1)] * (SIZE + 1) for k in languages}
    for _ in range(rounds):
        new = {}
        for k in languages:
            counts = [smooth] * (SIZE + 1)
            for text, lang in rows:
                if lang != k:
                    continue
                for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
                    ways = [(math.prod(prob[k][i] for i in s), s) for s in splits(MARK + word)]
                    for p, s in ways:
                        for i in s:
                            counts[i] += p / sum(x for x, _ in ways)
            new[k] = [c / sum(counts) for c in counts]
        prob = new
    return languages, prob


def brute_prediction(text, rows, languages, prob):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return "und", 0.0
    total = Counter(k for _, k in rows)

    @cache
    def log_word(word, k):
        return math.log(sum(math.prod(prob[k][i] for i in s) for s in splits(MARK + word)))
    logs = [math.log(total[k] / len(rows)) + sum(log_word(w, k) for w in words) for k in languages]
    most = max(logs)
    return languages[logs.index(most)], 1 / sum(math.exp(x - most) for x in logs)


def test_whole_predictions_against_recursion(spark):
    train = [("Abab ab, cab! abc", "x"), ("aba aba\nAB", "x"), ("ccc-bbb cb1bc zz", "y"), ("b b b", "y"), (None, "y"), ("cbcb é", "z"), ("", "z")]
    texts = [t for t, _ in train] + ["abc abc", "q", "zzz bc", "12 !", "b" * 9, "abab" * 3 + " c"]
    languages, prob = brute_model(train)
    docs = spark.createDataFrame(train, "text string, lang string").repartition(3)
    model = language_id.train(spark, docs, PIECES)
    assert model[0] == languages
    assert np.allclose(model[2], np.array([prob[k] for k in languages]).T)
    more = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.predict(more, model, PIECES, ["doc_id"]).collect():
        name, score = brute_prediction(texts[r.doc_id], train, languages, prob)
        assert (r.lang_pred, pytest.approx(r.score, abs=1e-9)) == (name, score)


def test_long_runs_are_one_word():
    """No cut and no underflow, however long a run and however large the corpus."""
    table = Pieces(PIECES)
    prob = np.full((SIZE + 1, 2), 1e-15)
    prob[:, 1] = 1e-13
    word = MARK + "ab" * 3000
    logs = word_logs(table.lattice([word]), np.log(prob))[0]
    best = [[0.0], [0.0]]  # the recursion in logarithms, place by place
    for k in range(2):
        for end in range(1, len(word) + 1):
            terms = [best[k][end - n] + math.log(prob[PIECES.index(word[end - n:end]) if word[end - n:end] in PIECES else SIZE, k])
                     for n in range(1, min(3, end) + 1) if n == 1 or word[end - n:end] in PIECES]
            top = max(terms)
            best[k].append(top + math.log(sum(math.exp(t - top) for t in terms)))
    assert np.allclose(logs, [best[0][-1], best[1][-1]], rtol=1e-12)
    counts = np.zeros((SIZE + 1, 2))
    expected(table.lattice([word]), prob, np.array([[1.0, 2.0]]), counts)
    letters = sum(counts[i] * len(p) for i, p in enumerate(PIECES)) + counts[SIZE]
    assert np.allclose(letters, [len(word), 2 * len(word)])  # every letter lies in one piece


def test_slices_of_languages_change_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    prob, table = rng.dirichlet(np.ones(SIZE + 1), 7).T, Pieces(PIECES)
    lattice, weight = table.lattice([MARK + "abac", MARK + "zbab"]), rng.random((2, 7))
    whole, parts = np.zeros((SIZE + 1, 7)), np.zeros((SIZE + 1, 7))
    expected(lattice, prob, weight, whole)
    logs = log_forward(lattice, np.log(prob))[-1]
    monkeypatch.setattr(language_id, "CELLS", 30)
    expected(lattice, prob, weight, parts)
    assert np.allclose(whole, parts) and np.allclose(logs, word_logs(lattice, np.log(prob)))


def test_number_of_languages_and_clashing_names(spark):
    docs = spark.range(12).selectExpr("id AS doc_id", "'ab ba' AS text", "concat('l', id) AS lang", "7 AS __held", "id AS held_out", "'k' AS k", "1 AS n")
    with pytest.raises(ValueError):
        language_id.train(spark, docs, PIECES, most_languages=11)
    assert len(language_id.train(spark, docs, PIECES, most_languages=12)[0]) == 12
    out = language_id.identify(spark, docs, F.col("doc_id") == 3).collect()
    assert sorted(r.doc_id for r in out if r.held_out) == [3] and len(out) == 12
