"""Operators against plain Python on odd and random texts."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from tests.llm.conftest import odd_texts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}


def order(rows):
    return sorted(rows, key=repr)


def shingles(text, size):
    w = WORDS.findall((text or "").translate(LOW))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def groups(rows, size):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and sets[j]:
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(find(k)) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, odd, size):
    from punctual.llm import near_dedup

    got = near_dedup.near_duplicates(spark, odd, size).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert order(map(tuple, got)) == order(groups(odd_texts(), size))


def test_chains_and_stars_lose_no_link(spark):
    """Groups whose members are similar to one member only, or along a chain."""
    from punctual.llm import near_dedup

    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = [f"w{g}_{i}" for i in range(100)]
        rows.append((1000 * g + 500, " ".join(base)))
        for v in range(25):  # each differs from the base in its own few places
            w = list(base)
            for i in rng.sample(range(100), 5):
                w[i] = f"x{g}_{v}_{i}"
            rows.append((1000 * g + v, " ".join(w)))
        chain = list(base)
        for v in range(8):
            chain = [*chain[6:], *(f"y{g}_{v}_{i}" for i in range(6))]
            rows.append((1000 * g + 600 + v, " ".join(chain)))
    got = near_dedup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), 2)
    got = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert order(map(tuple, got)) == order(groups(rows, 2))


def test_links_of_one_bucket_without_a_common_original(spark, monkeypatch):
    """All texts share every bucket: links between a class that the first star took
    and one that it did not, and rare links among many different texts, are found."""
    from punctual.llm import near_dedup

    rng = random.Random(3)

    def changed(w, places, tag):
        return [f"{tag}_{i}" if i in places else x for i, x in enumerate(w)]

    rows = []
    for g in range(1):
        base = [f"w{g}_{i}" for i in range(120)]
        rows.append((1000 * g, " ".join(base)))
        for v in range(15):  # near the base, each near one more that is not
            a = changed(base, set(range(v, v + 12)), f"a{g}_{v}")
            d = changed(a, set(range(v + 14, v + 26)), f"d{g}_{v}")
            rows += [(1000 * g + 2 * v + 1, " ".join(a)), (1000 * g + 2 * v + 2, " ".join(d))]
    for v in range(12):  # pairs, unlike all others
        w = [f"p{v}_{i}" for i in range(100)]
        rows += [(9000 + 2 * v, " ".join(w)), (9001 + 2 * v, " ".join(changed(w, set(rng.sample(range(100), 3)), "q")))]
    keys = near_dedup.Signer.keys
    monkeypatch.setattr(near_dedup.Signer, "keys", lambda self, g: keys(self, g)[:1] * 0 + 1)
    got = near_dedup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), 1)
    got = got.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert order(map(tuple, got)) == order(groups(rows, 1))


def test_signature_agreement_estimates_similarity():
    from punctual.llm.near_dedup import Signer

    signer, rng = Signer(), np.random.default_rng(2)
    for size in (3, 20, 400):
        agree = []
        for _ in range(150):
            u = rng.integers(0, 2 ** 63, size * 2, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(u[:size + size // 2]), np.sort(u[size // 2:])
            agree.append((signer.minima(a) == signer.minima(b)).mean())
        assert abs(np.mean(agree) - 0.5) < 0.06  # size common values of 2 * size


def test_repeat_spans(spark, odd):
    from punctual.llm import repeat_spans

    data = [(i, (t or "").encode()) for i, t in odd_texts()]
    seen = collections.Counter(t[i:i + 200] for _, t in data for i in range(len(t) - 199))
    want = []
    for i, t in data:
        hit = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                hit[k] += 1
                hit[k + 200] -= 1
        cover = np.cumsum(hit)[:len(t)] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~cover])
        spans = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        want.append((i, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = repeat_spans.remove_repeats(spark, odd, keep_first=False, full=False).collect()
    assert order(map(tuple, got)) == order(want)


@pytest.mark.parametrize("hot", [1, 256])
def test_repeat_spans_keep_first(spark, hot, monkeypatch):
    from punctual.llm import repeat_spans

    monkeypatch.setattr(repeat_spans, "HOT", hot)
    monkeypatch.setattr(repeat_spans.repeated_ranges, "__defaults__", (hot,))
    rng = random.Random(8)
    parts = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(30, 260))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))) for i in range(40)]
    rows += [(50, "ab" * 400), (51, "q" * 1000)]
    first, want = {}, []
    for i, t in rows:
        for k in range(len(t) - 199):
            first.setdefault(t[k:k + 200], (i, k))
    for i, t in rows:
        cover = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if first[t[k:k + 200]] != (i, k):
                cover[k:k + 200] = True
        want.append((i, "".join(c for c, gone in zip(t, cover) if not gone)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeat_spans.remove_repeats(spark, df, keep_first=True).select("doc_id", "kept").collect()
    assert order((i, bytes(k).decode()) for i, k in got) == order(want)
    both = repeat_spans.remove_repeats(spark, df, keep_first=False).select("doc_id", "n_removed").collect()
    seen = collections.Counter(t[k:k + 200] for _, t in rows for k in range(len(t) - 199))
    for i, n in both:
        t = dict(rows)[i]
        cover = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                cover[k:k + 200] = True
        assert n == cover.sum()


def test_repeat_spans_of_common_lines(spark, monkeypatch):
    """A line and a passage in most of the texts, at different neighbours: far more
    different runs of an anchor than are compared at once."""
    from punctual.llm import repeat_spans

    monkeypatch.setattr(repeat_spans.repeated_ranges, "__defaults__", (3,))
    rng = random.Random(12)

    def noise(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))
    line, passage, ends = noise(110), noise(330), [noise(120) for _ in range(4)]
    rows = []
    for i in range(60):
        text = noise(rng.randint(0, 150)) + (line if i % 3 else rng.choice(ends) + line + rng.choice(ends))
        rows.append((i, text + noise(rng.randint(0, 9)) + (passage if i % 2 else passage[rng.randint(0, 200):]) + rng.choice(ends)[:rng.randint(0, 120)]))
    seen = collections.Counter(t[k:k + 200] for _, t in rows for k in range(len(t) - 199))
    want = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                gone[k:k + 200] = True
        want.append((i, "".join(c for c, out in zip(t, gone) if not out)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeat_spans.remove_repeats(spark, df, keep_first=False).select("doc_id", "kept").collect()
    assert order((i, bytes(k).decode()) for i, k in got) == order(want)


@pytest.mark.parametrize("length", [3, 8, 13, 64, 200])
def test_longest_previous_factor(length):
    from punctual.llm.repeat_spans import factors

    rng = random.Random(length)
    text = bytes(rng.choice(b"ab") for _ in range(180)) + b"ab" * 60
    starts = np.arange(max(1, len(text) - length + 1))

    def common(i, j):
        k = 0
        while k < length and max(i, j) + k < len(text) and text[i + k] == text[j + k]:
            k += 1
        return k
    lpf, other = factors(np.frombuffer(text, np.uint8), starts, length)
    assert list(lpf) == [max((common(i, j) for j in starts if j < i), default=0) for i in starts]
    assert list(other) == [max((common(i, j) for j in starts if j != i), default=0) for i in starts]


def test_text_statistics(spark, odd):
    from punctual.llm import quality_rules

    want = []
    for i, t in odd_texts():
        t = t or ""
        w = WORDS.findall(t)
        seen = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        cover = set()
        for k in range(len(w) - 4):
            if seen[tuple(w[k:k + 5])] > 1:
                cover.update(range(k, k + 5))
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), failed))
    out, model = quality_rules.judge(spark, odd, ["doc_id"])
    got = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert order(map(tuple, got)) == order(want)
    votes = [f"vote_{r.name}" for r in quality_rules.RULES]
    for r in out.collect():
        p = model.posterior(tuple(r[v] for v in votes))[0]
        assert abs(p - r.p_good) < 1e-9 and r.kept == (not r.base_failed and r.p_good >= 0.5)


def test_estimation_finds_planted_accuracies():
    from punctual.llm.quality_rules import VoteRule, fit

    rng = np.random.default_rng(0)
    rules = tuple(VoteRule(f"r{i}", "junk") for i in range(4)) + tuple(VoteRule(f"s{i}", "spam") for i in range(3))
    kind = rng.choice(3, 40_000, p=[0.8, 0.12, 0.08])
    votes = np.zeros((len(kind), 7), int)
    for j in range(7):
        own = 1 if j < 4 else 2
        p_bad = np.where(kind == own, 0.85, 0.03)
        votes[:, j] = np.where(rng.random(len(kind)) < p_bad, -1, np.where(rng.random(len(kind)) < 0.6, 1, 0))
    counts = collections.Counter(map(tuple, votes.tolist()))
    model = fit(sorted(counts.items()), rules)
    assert abs(model.share[0] - 0.8) < 0.02
    good = {v: model.posterior(v)[0] >= 0.5 for v in counts}
    right = np.mean([good[tuple(v)] == (k == 0) for v, k in zip(votes.tolist(), kind)])
    assert right > 0.98


def test_edit_matching(spark):
    from punctual.llm import decontaminate

    rng = random.Random(5)

    def brute(p, t):
        prev = [0] * (len(t) + 1)
        for i in range(1, len(p) + 1):
            cur = [i]
            for j in range(1, len(t) + 1):
                cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (p[i - 1] != t[j - 1])))
            prev = cur
        return min(prev)
    items = [(k, "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 120)))) for k in range(12)] + [(90, None), (91, ""), (92, "zz")]
    docs = [(1, None), (2, ""), (None, "zz")]
    for d in range(3, 40):
        k, p = rng.choice(items[:12])
        q = list(p)
        for _ in range(rng.randint(0, len(p) // 7)):
            i = rng.randrange(len(q) + 1)
            q[i:i + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
        docs.append((d, "".join(rng.choice("abcde \n") for _ in range(rng.randint(0, 200))) + "".join(q).upper() + "b" * rng.randint(0, 30)))
    docs.append(docs[5])
    want = []
    for d, t in docs:
        for k, p in items:
            if p:
                fold = (t or "").translate(decontaminate.FOLD)
                m = brute(p.translate(decontaminate.FOLD), fold)
                if m <= int(len(p) * 0.1):
                    want.append((d, k, m))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(spark, df, bench, ["doc_id"])
    assert order((r.doc_id, r.item_id, r.distance) for r in got.collect()) == order(want)
    blocks = decontaminate.matches(spark, df, bench, ["doc_id"], block_chars=200)
    assert order(map(tuple, blocks.collect())) == order(map(tuple, got.collect()))
    for r in got.join(df.dropDuplicates(["doc_id"]), "doc_id").collect():
        p = dict(items)[r.item_id].translate(decontaminate.FOLD)
        part = r.text.translate(decontaminate.FOLD)[r.start:r.end]
        assert decontaminate.distance(p, part)[0] <= r.distance and abs(len(part) - len(p)) <= r.distance
    assert not set(d for d, _, _ in want) & {r.doc_id for r in decontaminate.drop_matches(spark, df, bench).collect()}


def test_base_scores(spark, odd):
    from pyspark.sql import functions as F

    from punctual.llm import lm_scoring

    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 4 == 0
    rows = odd_texts()
    tokens = [WORDS.findall((t or "").translate(LOW)) + ["</s>"] for _, t in rows]
    train = [x for (i, _), x in zip(rows, tokens) if (i or 0) % 4]
    c = collections.Counter(w for x in train for w in x)
    n, v = sum(c.values()), len(c)
    want = [(i, (i or 0) % 4 == 0, len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x))
            for (i, _), x in zip(rows, tokens)]
    for head in (200_000, 7):
        got = lm_scoring.score(spark, odd, held, head_size=head, words=5).collect()
        assert all(r.score < 0 for r in got)
        got = order((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
        assert got == order((*w[:5], round(w[5], 5)) for w in want)


def test_model_is_normalised_and_learns():
    from punctual.llm.lm_scoring import LogBilinear

    rng = np.random.default_rng(3)
    cls = np.zeros(40_000, int)
    for i in range(2, len(cls)):  # a class mostly follows from the one before
        cls[i] = (cls[i - 1] + 1) % 5 if rng.random() < 0.8 else rng.integers(6)
    unigram = np.bincount(cls, minlength=6) / len(cls)
    model = LogBilinear(5, unigram=unigram)
    log_noise = (np.log(16) + np.log(unigram)).astype(np.float32)
    for i in range(2, len(cls) - 512, 256):
        j = np.arange(i, i + 256)
        model.step(cls[j - 1], cls[j - 2], cls[j], rng.choice(6, 16, p=unigram), log_noise, 0.05)
    every = np.array([[model.log_probs(np.array([a]), np.array([b]), np.array([k]))[0] for k in range(6)] for a in range(6) for b in range(6)])
    assert np.allclose(np.exp(every).sum(axis=1), 1, atol=1e-4)
    j = np.arange(2, len(cls))
    assert model.log_probs(cls[j - 1], cls[j - 2], cls[j]).mean() > np.log(unigram)[cls[j]].mean() + 0.5


def test_bpe_equals_the_library(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    from punctual.llm import bpe

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    rng = random.Random(1)
    texts = [x or "" for _, x in odd_texts()] + [
        "".join(rng.choice(" \n\t'aAsé1½.,$中\x1c\x85 <|>") for _ in range(rng.randint(1, 60))) for _ in range(1500)] + [
        "".join(chr(rng.choice([rng.randint(0, 0x2fff), rng.randint(0, 255), rng.randint(0x1f000, 0x1ffff)])) for _ in range(30)) for _ in range(1000)] + [
        " ".join(rng.choice(["a", "b\nc", "x ", "　y", "z's", "\n", "<|endoftext|>", "q<|endoftext|>"]) for _ in range(10)) for _ in range(500)]
    content, pattern = bpe.public_vocabulary()
    rows = list(enumerate(texts))
    got = bpe.encode_decode(spark.createDataFrame(rows, "doc_id long, text string"), content, pattern, full=True).collect()
    for r in got:
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.decoded == back and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_pieces_forgotten_are_learnt_again():
    from punctual.llm import bpe

    content, pattern = bpe.public_vocabulary()
    small, large = bpe.Codec(content, pattern, remember=3, flat=10), bpe.Codec(content, pattern)
    texts = [t or "" for _, t in odd_texts()][:12]
    for _ in range(2):
        for t in texts:
            assert list(small.encode([t])) == list(large.encode([t]))


def test_forward_sums_all_segmentations():
    from punctual.llm.language_id import Pieces, expected, forward

    pieces = ["a", "ab", "b", "ba", "▁", "▁a"]
    table, rng = Pieces(pieces), np.random.default_rng(0)
    prob = rng.random((7, 2))

    def brute(w, k):
        if not w:
            return 1.0
        total = 0.0
        for size in range(1, 3):
            p = w[:size]
            if len(p) == size and p in pieces:
                total += prob[pieces.index(p), k] * brute(w[size:], k)
            elif size == 1:
                total += prob[6, k] * brute(w[1:], k)
        return total
    for w in ("▁abab", "▁xbaa", "▁"):
        lattice = table.lattice([w, w])
        assert np.allclose(forward(lattice, prob)[:, -1], [[brute(w, 0), brute(w, 1)]] * 2)
        counts = np.zeros((7, 2))
        expected(lattice, prob, np.ones((2, 2)), counts)
        eps = 1e-6  # d log P / d log p of a piece is its expected count
        for i in range(7):
            up = prob.copy()
            up[i] *= 1 + eps
            slope = (np.log(forward(lattice, up)[:, -1]) - np.log(forward(lattice, prob)[:, -1])).sum(axis=0) / eps
            assert np.allclose(counts[i], slope, atol=1e-3)


def labelled_points(seed, n=400):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)  # many ties
    y = ((x[:, 0] > 0.3) & (x[:, 2] <= 0.5) | (rng.random(n) < 0.1)).astype(float)
    return x, y


def test_trees_against_all_splits():
    from punctual.llm import rule_ensemble as e

    for seed in range(5):
        x, y = labelled_points(seed)
        cuts = [np.unique(c)[:-1:3] for c in x.T]
        bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
        nodes = e.grow(bins, cuts, y - y.mean(), 3, 7)
        of = {path: set(rows.tolist()) for path, rows, _ in nodes} | {(): set(range(len(y)))}
        for path, rows, value in nodes:
            assert set(np.flatnonzero(e.truth(x, [path])[:, 0]).tolist()) == set(rows.tolist())
            assert (e.truth(x, [e.simplify(path)]) == e.truth(x, [path])).all()
            assert math.isclose(value, (y - y.mean())[rows].mean())
        for parent in {path[:-1] for path, _, _ in nodes}:
            inside = np.array(sorted(of[parent]))
            r = (y - y.mean())[inside]

            def loss(f, t):
                left = x[inside, f] <= t
                if min(left.sum(), (~left).sum()) < 7:
                    return math.inf
                return sum(((part - part.mean()) ** 2).sum() for part in (r[left], r[~left]))
            f, _, t = next(p[-1] for p in of if p and p[:-1] == parent)
            assert math.isclose(loss(f, t), min(loss(g, c) for g in range(4) for c in cuts[g]), rel_tol=1e-9)


def test_lasso_is_optimal():
    from punctual.llm import rule_ensemble as e

    x, y = labelled_points(9)
    rules = [((f, above, t),) for f in range(4) for above in (False, True) for t in (-0.7, 0.3, 0.5)]
    rules += [tuple(a + b) for a, b in zip(rules[:6], rules[13:])]
    z = e.truth(x, rules)
    model = e.lasso(z, y, rules, ("a", "b", "c", "d"), 0.0, 0.01, 5000)
    weight = dict(model.rules)
    assert 0 < len(weight) < len(rules)
    off = model.predict(x) - y
    assert abs(off.mean()) < 1e-4  # the bias has no penalty
    for j, rule in enumerate(rules):  # conditions of a minimum of mean loss + penalty * |weights|
        slope = ((z[:, j] - z[:, j].mean()) * off).mean()
        if rule in weight:
            assert abs(slope + 0.01 * np.sign(weight[rule])) < 1e-3
        else:
            assert abs(slope) < 0.01 + 1e-3


def test_compiled_rules_score_like_the_model(spark):
    from pyspark.sql import functions as F

    from punctual.llm import rule_ensemble as e
    from punctual.llm.text_stats import with_stats

    x, y = labelled_points(4)
    model = e.fit(x, y, ("a", "b", "c", "d"), trees=6)
    assert model.rules
    edges = [t for rule, _ in model.rules for _, _, t in rule]
    x = np.concatenate((x, np.random.default_rng(1).choice(edges, (200, 4))))  # values on the thresholds
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i long, a double, b double, c double, d double")
    got = np.array([r.score for r in rows.select("i", model.column().alias("score")).orderBy("i").collect()])
    assert np.allclose(got, model.predict(x), atol=1e-12)

    # whole predictions of the operator, from features taken here
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scored, model = e.classify(spark, docs, labels, F.col("doc_id") % 3 == 0)
    stats = with_stats(docs, ["doc_id"]).select("doc_id", *[F.expr(v).cast("double") for v in e.FEATURES.values()])
    table = {r[0]: list(r[1:]) for r in stats.collect()}
    want = dict(zip(table, model.predict(np.array(list(table.values())))))
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id % 3 and r.doc_id in table}
    again = e.fit(*(np.array(v, float) for v in zip(*sorted((table[i], q) for i, q in known.items()))))
    back = dict(zip(table, again.predict(np.array(list(table.values())))))
    for r in scored.collect():
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-9) and r.predicted == (r.score >= 0.5)
        assert math.isclose(r.score, back[r.doc_id], rel_tol=1e-6)
