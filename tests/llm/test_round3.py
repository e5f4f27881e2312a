"""Rank-file BPE, hard negatives and periodic runs against the library, SQL and
plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from punctual.llm import catalog, hard_negatives, periodic_runs, rank_bpe
from tests.llm.conftest import odd_texts
from tests.llm.test_brute import WORDS, order

SF = "/root/testdata/sf0.001"


def library():
    import tiktoken

    content, pattern = rank_bpe.public_ranks()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=rank_bpe.parse(content), special_tokens={})


def bpe_rows(rows):
    enc, out = library(), []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return order(out)


@pytest.mark.parametrize("slice_chars", [50, 4_000_000])
def test_rank_bpe(spark, odd, empty, slice_chars):
    content, pattern = rank_bpe.public_ranks()
    got = rank_bpe.encode_decode(odd, content, pattern, slice_chars=slice_chars, remember=200)
    assert order(map(tuple, got.collect())) == bpe_rows(odd_texts())
    assert rank_bpe.encode_decode(empty, content, pattern).count() == 0
    full = rank_bpe.encode_decode(odd, content, pattern, key="c", full=True).collect()
    assert all(len(r.ids) == r.n_tokens and hashlib.sha256(r.decoded).hexdigest() == r.decoded_sha256 for r in full)


def test_rank_bpe_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert order(map(tuple, catalog.QUERIES["op11_rank_bpe"](spark, SF).collect())) == bpe_rows(docs)


def test_rank_bpe_pieces():
    """Random pieces of few different bytes, long ones too; linear in length."""
    import time

    content, _ = rank_bpe.public_ranks()
    encoder, enc, rng = rank_bpe.Encoder(rank_bpe.Tables(content)), library(), random.Random(3)
    for letters in ("ab", "aein", " \n", "=-", "théñ", "中文字", "0123"):
        for n in (1, 2, 3, 7, 20, 300):
            for _ in range(40):
                piece = "".join(rng.choice(letters) for _ in range(n))
                assert encoder.encode(piece.encode()) == enc._encode_single_piece(piece), piece
    for piece in ("a" * 200_000, "".join(rng.choice("abcdefgh") for _ in range(200_000))):
        began = time.time()
        ids = encoder.encode(piece.encode())
        assert time.time() - began < 10 and ids == enc._encode_single_piece(piece)


def test_rank_files_that_are_no_merges():
    lines = [b"%s %d" % (__import__("base64").b64encode(bytes([b])), b) for b in range(256)]
    with pytest.raises(ValueError):
        rank_bpe.Tables(b"\n".join([*lines, __import__("base64").b64encode(b"abc") + b" 256"]))
    with pytest.raises(ValueError):
        rank_bpe.Tables(b"\n".join(lines[1:]))


# ------------------------------------------------------------ periodic runs

def brute_runs(words):
    n, out = len(words), set()
    for s in range(n):
        for q in range(1, (n - s) // 4 + 1):
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s < max(6, 4 * q) or (s and words[s - 1] == words[s - 1 + q]):
                continue
            if not any((s, e - s, p) in out for p in range(1, q)):
                out.add((s, e - s, q))
    return sorted(out)


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    rng, parts = random.Random(5), []
    for k in range(400):
        words = []
        while len(words) < rng.choice([3, 30, 120]):
            root = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            words += (root * rng.randint(1, 7))[:rng.randint(1, 40)]
        parts.append(words)
    parts += [[], ["a"] * 6, ["a"] * 5, list("ab") * 4, list("abcabcabcabc"), list("aab") * 4 + ["x"] + list("ab") * 30]
    ids = np.array([ord(w) for p in parts for w in p], np.int64)
    ends = np.cumsum([len(p) for p in parts])
    got = list(zip(*map(list, periodic_runs.runs_of(ids, ends, 6, 4))))
    want = [(s + e - len(p), n, q) for p, e in zip(parts, ends.tolist()) for s, n, q in brute_runs(p)]
    assert [tuple(map(int, r)) for r in got] == want


def looped(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def run_rows(rows):
    out = []
    for i, t in rows:
        words = looped(i, WORDS.findall(t or ""))
        runs = fast_runs(words)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        out.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    return order(out)


def fast_runs(words):
    """All lags, each compared as a whole."""
    ids = np.unique(np.array(words or [""]), return_inverse=True)[1][:len(words)]
    out = {}
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate(([False], ids[q:] == ids[:-q], [False]))
        for s, e in zip(np.flatnonzero(~same[:-1] & same[1:]).tolist(), np.flatnonzero(same[:-1] & ~same[1:]).tolist()):
            if e - s + q >= max(6, 4 * q):
                out.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def test_periodic_runs(spark, odd, empty):
    detect = lambda docs: periodic_runs.digest(periodic_runs.detect(periodic_runs.looped(docs)))
    assert order(map(tuple, detect(odd).collect())) == run_rows(odd_texts())
    assert detect(empty).count() == 0
    text = "p " + "a " * 9 + "q  x y  x y  x y  x y  z"
    got = periodic_runs.detect(spark.createDataFrame([(7, text)], "k int, body string"), "k", "body").first()
    assert [tuple(r) for r in got.runs] == [(1, 9, 1)] and got.collapsed == "p a q  x y  x y  x y  x y  z"
    docs = [(i, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * (i % 5)) for i in range(300)]
    assert order(map(tuple, detect(spark.createDataFrame(docs, "doc_id long, text string")).collect())) == run_rows(docs)
    with pytest.raises(ValueError):
        periodic_runs.detect(odd, times=2)


def test_periodic_runs_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op13_periodic_runs"](spark, SF)
    assert got.where("n_runs > 0").count() > 5
    assert order(map(tuple, got.collect())) == run_rows(docs)


def test_long_repeats_take_little_time():
    import time

    began = time.time()
    ids = np.concatenate((np.zeros(300_000, np.int64), np.arange(300_000) % 7, np.arange(300_000) % 100_000, np.arange(200_000)))
    start, length, period = periodic_runs.runs_of(ids, np.array([len(ids)]), 6, 4)
    assert time.time() - began < 20 and (0, 300_001, 1) in zip(start.tolist(), length.tolist(), period.tolist())


# ------------------------------------------------------------ hard negatives

def brute_mine(rows):
    import math

    take = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(take):
        if i is None or i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0, other) for b, (j, other, w) in enumerate(take) if b != a]
        scored.sort(key=lambda r: r[:3])
        for s, none, j, other in [r for r in scored if r[3] == label][:5]:
            hits = [r for r in scored if r[3] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(i, None if none else j, k + 1, None if r[1] else r[2], -s, -r[0]) for k, r in enumerate(hits)]
    return order(out)


def vectors():
    rng = random.Random(8)
    hot = [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, rng.randrange(4), hot if rng.random() < 0.3 else [rng.gauss(0, 1) for _ in range(6)]) for i in range(700)]
    rows += [(50, 1, hot), (50, 1, hot), (None, 2, hot), (None, 1, hot), (7000, None, hot), (7050, 1, None), (7100, 1, [1.0, None]), (7150, 2, [float("nan")]),
             (7200, 2, [float("inf"), 1.0]), (7250, 3, []), (7300, 3, [1.0]), (7350, 9, hot), (-50, 2, [-x for x in hot]), (7400, 1, [0.0] * 6)]
    return rows


def test_hard_negatives(spark):
    from pyspark.sql import functions as F

    schema = "vec_id long, label int, embedding array<double>, score long, block long, batch int, k string"
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in vectors()], schema)
    for block_rows, seeds in ((16, 1), (2048, 2)):
        got = hard_negatives.mine(spark, df, F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("vec_id") % 50 == 0, block_rows=block_rows, seeds=seeds)
        assert order(map(tuple, got.collect())) == brute_mine(vectors())
    none = hard_negatives.mine(spark, df.where("false"), F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("vec_id") % 50 == 0)
    assert none.count() == 0 and none.columns == got.columns
    large = [(i, i % 3, [x * 1e300 for x in (1.0, -1.0, i)]) for i in range(0, 300, 25)]
    wide = spark.createDataFrame(large, "vec_id long, label int, embedding array<double>")
    assert hard_negatives.mine(spark, wide, F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("vec_id") % 50 == 0).where("abs(positive_score) > 2305843009213693952").count() == 0


def test_bounds_and_curve():
    rng = np.random.default_rng(2)
    a, rows = rng.integers(-300, 300, (20, 9)), rng.integers(-300, 300, (50, 9))
    least, most = hard_negatives.bounds(a, rows.min(0)[None], rows.max(0)[None])
    s = a @ rows.T
    assert (s >= least).all() and (s <= most).all() and (hard_negatives.products(a, rows) == s).all()
    big = a * (1 << 40)
    assert (hard_negatives.products(big, rows) == big @ rows.T).all()
    assert hard_negatives.products(a * (1 << 52), rows * (1 << 52)).max() == 1 << 61
    # every cell once, neighbours along the curve one step apart
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        key = hard_negatives.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# ------------------------------------------------------------ secrets in long texts

def test_near_misses_of_a_megabyte(spark):
    """Texts that a rule nearly matches over and over, and keys with many header
    lines: linear time, same spans as the SQL."""
    import time

    import duckdb

    from punctual.llm import secret_scan
    from tests.helpers import rows

    begin, end = "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"
    lines = "".join(f"Header-{i}: v-{i}, (x)\n" for i in range(60))
    small = [f"a {begin}\n{lines}\nQUJD\n{end} b", "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + ".c-d. then", "x-eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + ".sig eyJa.eyJb.c",
             f"{begin} -- {end}", f"{begin}{begin}QQ=={end}", "-----BEGIN RSA  PRIVATE KEY----- x"]
    units = ["A ", "eyJ", "-eyJ", "eyJaaaaaaaaa.", "eyJaaaaaaaaa.eyJ", begin, begin + "\n", "-----BEGIN ", "-----END ", "\n", "-", "password ", "password=", "token: ", "AKIA", "f",
             "'", "api_", "Aa-1: b\n"]
    long = ["-----BEGIN " + "A " * 500_000, begin + "\n" * 300_000, *[(u * (300_000 // len(u) + 1))[:300_000] for u in units], begin + "- a" * 100_000 + end]
    docs = spark.createDataFrame(list(enumerate(small + long)), "doc_id long, text string").repartition(8).cache()
    docs.count()
    began = time.time()
    got = secret_scan.digest(spark, docs, secret_scan.new_ledger(spark)).toPandas()
    assert time.time() - began < 120
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert rows(got) == rows(con.execute(secret_scan.ORACLE).df())
    spans = dict(zip(got.doc_id, got.spans))
    assert spans[0] == f"pem:2:{len(small[0]) - 2}" and spans[1] == "jwt:0:29" and spans[2] == "jwt:2:31"
    assert spans[len(small) + len(long) - 1].startswith("pem:0:") and spans[4] == "pem:0:27,pem:27:%d" % len(small[4])
