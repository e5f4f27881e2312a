from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, c long, bands string, "
          "spans string, n_words long, host string, score double, th string, blob_id string, a int, z string")
SYLLABLES = ["the", "on", "re", "ti", "an", "es", "or", "ing", "st", "en", "ha", "wh", "ly", "ble"]


def word(rng) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, words: int) -> str:
    out = []
    for i in range(words):
        out.append(word(rng) + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else " "))
    return "".join(out).strip()


def odd_texts() -> list[tuple]:
    """(doc_id, text): null, empty and blank texts, null ids, very long texts,
    exact and near copies, repeated rows."""
    rng = random.Random(4)
    base = [prose(rng, n) for n in (60, 80, 120, 200, 9, 12)]
    long = prose(rng, 30_000)
    words = base[1].split(" ")
    near = " ".join(["other", "first", *words[2:]])
    other = " ".join([*words[:-1], "ending"])
    shared = prose(rng, 70)
    rows = [(1, None), (2, ""), (3, " \n\t \x0b"), (4, "one"), (5, "One"), (None, base[0]), (None, None),
            (10, base[0]), (11, base[0]), (11, base[0]), (12, base[1]), (13, near), (14, other), (15, base[1].upper()),
            (20, long), (21, "Begin " + long), (22, base[2] + " " + shared), (23, shared + " " + base[3]), (24, base[3]),
            (25, base[4]), (26, base[5]), (27, "x" * 5000), (28, "é ñ ü 中文 " * 30), (29, "\U0001F600" * 40),
            (30, "key: token = 'abcdef0123456789' and password: secret: abcdefghijk"),
            (31, "AKIA" + "B" * 16 + " " + "0123456789abcdef" * 2 + " API_KEY=\"short\" apikey=longenough1"),
            (32, "é" * 7 + " passwd:'p4ssw0rd/+=' " + "deadbeef" * 4 + "x"), (33, "SECRET=" + "A" * 9),
            (34, "a b a b a b a b a b a b a b"), (35, "line one\nline one\n\nline two\nline one")]
    rows += [(100 + i, prose(rng, rng.randint(15, 90))) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    data = [(i, t, "en" if t else None, None if k % 3 else "src", len(t or ""), None, k, "x", "y", 5, "h", 0.5, "th", None, 1, None)
            for k, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
