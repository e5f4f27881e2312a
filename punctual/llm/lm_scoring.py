"""Language-model scoring with a log-bilinear neural model in numpy.

Counts of every token over all training texts are a Spark aggregation. The
model tells the most frequent words apart, 4 N^0.4 of N training tokens, so
their number grows with the corpus (1,750 at 4 million tokens, 6,000 at 85
million, some 800,000 words or 100 MB of parameters at 100 TB); all others share
one word. Context vectors of the two tokens before a token are scaled per place
and added. Words lie in classes of neighbours by count, as many classes as words
in a class: a class scores by its inner product with the sum and a bias, and so
does a word against the words of its class. Both are trained by noise-contrastive
estimation: in each round every task walks over all its training texts from the
same parameters, in minibatches of matrix products against noise words drawn from
the unigram (and their classes), and the parameters are averaged by tokens over
the tasks that moved them, one row a word. Scores are normalised: the probability
of a word is that of its class among all classes times its own within the class,
two sums over about the root of the vocabulary. A word of the shared one then has
its smoothed unigram share of it.

Counts of the HEAD most frequent words (or the model's words, if more) go to the
tasks; counts of all others are joined to the documents' rare words, per document.

Defined results: a null text is empty and has the one end token; without
training texts every count is 0; rows repeated with one id and text get the
same result each; a null id is an id like any other; ties in count are broken by
the word's hash; very long texts are scored whole; an empty table gives an empty
one; other columns are not read. Parameters depend a little on how the input is
split into tasks, counts and the base score don't. Words are compared as 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import LOWER, batches_of_bytes, byte_codes, materialize, ship, word_hashes, word_spans

HEAD = 200_000      # words whose counts are sent to the tasks (3.2 MB)
DIM = 16
PART = 1024         # rows of a matrix product, to stay in a core's cache
END = np.uint64(0x51ED270B7A1F39C5)  # the end token's hash


def vocabulary(total: int) -> int:
    """How many words the model tells apart after ``total`` training tokens."""
    return int(4 * total ** 0.4)


def tokens_of(buf: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all tokens, an end token after each text's words."""
    low = LOWER[buf]
    s, e, text = word_spans(low, ends)
    h = word_hashes(low, s, e, codes)
    last = np.searchsorted(text, np.arange(len(ends)), side="right")
    return np.insert(h, last, END), np.insert(text, last, np.arange(len(ends)))


def count_tokens(texts: DataFrame, room: int = 1_000_000) -> DataFrame:
    """w (token hash) and n over all rows of ``texts`` (one text column)."""

    def run(batches):
        codes = byte_codes(31)
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def rows(h, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["w", "n"])

        for batch in batches:
            for _, buf, ends in batches_of_bytes(batch.column(0)):
                h, n = np.unique_counts(tokens_of(buf, ends, codes)[0])
                both = np.concatenate((held[0], h))
                h, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, np.concatenate((held[1], n))).astype(np.int64)
                if len(h) > room:
                    yield rows(h, n)
                    h, n = h[:0], n[:0]
                held = (h, n)
        yield rows(*held)

    return texts.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, size: int) -> list[tuple[int, int]]:
    """(token, count) of the most frequent tokens, ``size`` at most, by count.

    The least count taken comes from a histogram of the counts (16 steps to a
    doubling, so about a thousand rows at most); a step that doesn't fit as a
    whole stays out. Only the tokens taken come to the driver.
    """
    step = F.floor(F.log2("n") * 16)
    left, least = size, None
    for s, n in sorted((tuple(r) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True):
        if n > left:
            break
        left, least = left - n, s
    if least is None:
        return []
    return sorted((tuple(r) for r in counts.where(step >= least).select("w", "n").collect()), key=lambda r: (-r[1], r[0]))


class Head:
    """Counts and model words of the most frequent tokens, found by a table of slots,
    and by binary search where another token holds the slot."""

    SLOTS = 20  # bits of a hash

    def __init__(self, rows: list[tuple[int, int]], size: int):
        w = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        n = np.array([r[1] for r in rows], np.int64)
        order = np.argsort(w)
        self.words, self.counts = w[order], n[order]
        self.shared = min(size, len(rows))  # the id of the shared word
        self.ids = np.minimum(order, self.shared)  # rows come by count
        self.slot = np.full(1 << self.SLOTS, -1, np.int32)
        self.slot[self.words >> np.uint64(64 - self.SLOTS)] = np.arange(len(w))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(is in the table, count, word of the model) of token hashes."""
        if not len(self.words):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        at = self.slot[h >> np.uint64(64 - self.SLOTS)]
        known = (self.words[at] == h) & (at >= 0)
        taken = np.flatnonzero((at >= 0) & ~known)
        at[taken] = np.minimum(np.searchsorted(self.words, h[taken]), len(self.words) - 1)
        known[taken] = self.words[at[taken]] == h[taken]
        return known, np.where(known, self.counts[at], 0), np.where(known, self.ids[at], self.shared)


def contexts(word: np.ndarray, text: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of the two tokens before each token of its text."""
    one, two = np.full(len(word), begin), np.full(len(word), begin)
    same = text[1:] == text[:-1]
    one[1:][same] = word[:-1][same]
    same = text[2:] == text[:-2]
    two[2:][same] = word[:-2][same]
    return one, two


class LogBilinear:
    """Parameters in one float32 table of rows (vector, bias): context vectors of
    the words and the begin mark, target vectors of the words, vectors of the
    classes, and two rows of scales, one per context place."""

    def __init__(self, words: int, dim: int = DIM, table: np.ndarray | None = None, unigram: np.ndarray | None = None):
        self.k, self.dim = words + 1, dim  # with the shared word
        self.size = math.isqrt(words) + 1  # words of a class
        self.firsts = np.arange(0, self.k, self.size)
        self.target = self.k + 1
        self.classes = self.target + self.k
        self.scales = self.classes + len(self.firsts)
        if table is None:
            table = np.zeros((self.scales + 2, dim + 1), np.float32)
            table[:, :dim] = np.random.default_rng(5).normal(0, 0.1, (len(table), dim))
            table[self.target:self.classes, dim] = np.log(unigram)
            table[self.classes:self.scales, dim] = np.log(np.add.reduceat(unigram, self.firsts))
            table[self.scales:, :dim] = 1
        self.table, self.squares, self.noise = table, np.zeros_like(table), (None, None)

    def scaled(self) -> tuple[np.ndarray, np.ndarray]:
        """The context vectors for each of the two places, with half of the bias' 1."""
        both = []
        for scale in self.table[self.scales:]:
            rows = self.table[:self.target] * scale
            rows[:, -1] = 0.5
            both.append(rows)
        return tuple(both)

    def class_noise(self, log_noise: np.ndarray) -> np.ndarray:
        """``log_noise`` of the classes, for half as many noise classes."""
        if self.noise[0] is not log_noise:
            self.noise = log_noise, np.log(np.add.reduceat(np.exp(log_noise), self.firsts) / 2)
        return self.noise[1]

    def step(self, one, two, word, noise, log_noise, rate: float) -> None:
        """One noise-contrastive step: each example against the same noise words
        (``log_noise``: log of noise count * unigram, per word) and its class
        against the classes of half of them."""
        n, m, kind, few = len(one), len(noise), word // self.size, noise[:len(noise) // 2] // self.size
        first, second = self.table[self.scales:].copy()
        before, earlier = self.table.take(one, axis=0), self.table.take(two, axis=0)
        hidden = before * first + earlier * second
        hidden[:, -1] = 1
        rare = self.class_noise(log_noise)
        at, other = np.concatenate((self.target + word, self.classes + kind)), np.concatenate((self.target + noise, self.classes + few))
        t, q = self.table.take(at, axis=0), -self.table.take(other, axis=0)
        q[:m, -1] += log_noise[noise]
        q[m:, -1] += rare[few]
        up = np.concatenate((log_noise[word], rare[kind]))
        up[:n] -= np.einsum("ij,ij->i", hidden, t[:n])
        up[n:] -= np.einsum("ij,ij->i", hidden, t[n:])
        up = (0.5 + 0.5 * np.tanh(up / 2))[:, None]
        t *= up
        grad, push = t[:n] + t[n:], np.zeros_like(q)
        half, all_q = q.T / 2, q.sum(axis=0) / 2
        for i in range(0, n, PART):  # a logistic function is half a tanh and a half, which need no pass of their own
            h = hidden[i:i + PART]
            bend = h @ half
            np.tanh(bend, out=bend)
            grad[i:i + PART] += all_q - (bend @ q) / 2
            push += (h.sum(axis=0) - bend.T @ h) / 2
        grad[:, -1] = 0
        scales = np.stack((np.einsum("ij,ij->j", grad, before), np.einsum("ij,ij->j", grad, earlier)))
        self.move(np.concatenate((at, other, one, two, [self.scales, self.scales + 1])),
                  np.concatenate((up[:n] * hidden, up[n:] * hidden, -push, grad * first, grad * second, scales)), rate)

    def move(self, at: np.ndarray, rows: np.ndarray, rate: float) -> None:
        """Gradient step on the rows ``at`` of the table with a step size per
        parameter: by the root of its squared gradients so far."""
        at = at.astype(np.min_scalar_type(len(self.table)))  # short keys have a faster stable sort
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        place = at[first].astype(np.int64)
        sums = np.add.reduceat(rows.take(order, axis=0), first, axis=0)
        squares = self.squares.take(place, axis=0) + sums * sums
        self.squares[place] = squares
        self.table[place] += np.float32(rate) * sums / np.sqrt(squares + np.float32(1e-6))

    def log_probs(self, one, two, word, part: int = PART) -> np.ndarray:
        """Natural log of the normalised probability of each word after its context."""
        out, kind = np.empty(len(word)), word // self.size
        order = np.argsort(kind.astype(np.min_scalar_type(self.k)), kind="stable")
        bounds = np.searchsorted(kind[order], np.arange(len(self.firsts) + 1))
        first, second = self.scaled()
        hidden = first.take(one, axis=0) + second.take(two, axis=0)
        classes, targets = self.table[self.classes:self.scales], self.table[self.target:self.classes]
        for at in range(0, len(word), part):
            some = slice(at, at + part)
            out[some] = among(hidden[some] @ classes.T, kind[some])
        for c in np.flatnonzero(np.diff(bounds)):
            a = self.firsts[c]
            for at in range(bounds[c], bounds[c + 1], part):
                some = order[at:min(at + part, bounds[c + 1])]
                out[some] += among(hidden.take(some, axis=0) @ targets[a:a + self.size].T, word[some] - a)
        return out


def among(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each row's score at ``at`` less the log of the sum of exponentials over the row."""
    most = scores.max()
    sums = np.exp(scores - most) @ np.ones(scores.shape[1], np.float32)
    out = scores[np.arange(len(at)), at] - most
    low = np.flatnonzero(sums < 1e-20)  # rows far below the greatest score
    if len(low):
        top = scores[low].max(axis=1)
        sums[low] = np.exp(scores[low] - top[:, None]).sum(axis=1)
        out[low] += most - top
    return out - np.log(sums)


def word_ids(texts: DataFrame, head: Head) -> DataFrame:
    """words: the model's words of each text, the end token included."""

    def run(batches):
        codes = byte_codes(31)
        for batch in batches:
            for _, buf, ends in batches_of_bytes(batch.column(0)):
                h, text = tokens_of(buf, ends, codes)
                places = np.searchsorted(text, np.arange(len(ends) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(places), pa.array(head.find(h)[2].astype(np.int32)))], ["words"])

    return texts.mapInArrow(run, "words array<int>")


def batches_of_ids(column, limit: int = 300_000):
    """(words, text of each) of runs of whole rows with about ``limit`` words."""
    places, values = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(places, places[at] + limit, side="right")) - 1)
        yield values[places[at]:places[end]].astype(np.int64), np.repeat(np.arange(end - at), np.diff(places[at:end + 1]))
        at = end


def train(spark: SparkSession, texts: DataFrame, head: Head, total: int, rounds: int = 2, rate: float = 0.05,
          batch_size: int = 4096, noises: int = 64) -> LogBilinear:
    """Rounds of noise-contrastive training over all texts, averaged by tokens. The
    texts are taken apart once; the rounds read the ids of their words."""
    counts = np.zeros(head.shared + 1)
    np.add.at(counts, head.ids, head.counts)
    counts[-1] += total - head.counts.sum()
    unigram = (counts + 1) / (counts.sum() + len(counts))
    model = LogBilinear(head.shared, unigram=unigram)
    names = [f"x{i}" for i in range(DIM + 1)]
    ids = materialize(spark, word_ids(texts, head), "words")
    for turn in range(rounds):
        table, words, speed = model.table.copy(), head.shared, rate / (1 + turn)

        def run(batches):
            own = LogBilinear(words, table=table.copy())
            rng, seen = np.random.default_rng(turn), 0
            log_noise = (np.log(noises) + np.log(unigram)).astype(np.float32)
            edges = np.cumsum(unigram)
            for batch in batches:
                for word, text in batches_of_ids(batch.column(0)):
                    one, two = contexts(word, text, words + 1)
                    for i in range(0, len(word), batch_size):
                        j = slice(i, i + batch_size)
                        noise = np.minimum(np.searchsorted(edges, rng.random(noises)), words)
                        own.step(one[j], two[j], word[j], noise, log_noise, speed)
                    seen += len(word)
            moved = np.flatnonzero(own.squares.any(axis=1))
            for at in range(0, len(moved), 10_000):
                i = moved[at:at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i), pa.array(np.full(len(i), float(seen))), *(pa.array(x * float(seen)) for x in own.table[i].T.astype(float))], ["i", "n", *names])

        rows = ids.mapInArrow(run, ", ".join(["i long", "n double", *(f"{x} double" for x in names)]))
        means = rows.groupBy("i").agg(*((F.sum(x) / F.sum("n")).alias(x) for x in names)).toArrow()  # one row a vector
        new = model.table.copy()
        new[means.column("i").to_numpy()] = np.stack([means.column(x).to_numpy() for x in names], axis=1)
        model = LogBilinear(head.shared, table=new)
    return model


def score(spark: SparkSession, docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text",
          words: int | None = None, head_size: int = HEAD) -> DataFrame:
    """Learn from the rows that aren't held out; for every row of ``docs``: key,
    held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigram) and
    score (the model), both log10 probabilities of the whole text. ``words``: how
    many the model tells apart (set by the corpus if not given)."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    learn = docs.where("NOT held_out").select("text")
    counts = materialize(spark, count_tokens(learn), "counts")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words = vocabulary(total) if words is None else words
    head = Head(most_frequent(counts, max(head_size, words)), words)
    table = train(spark, learn, head, total).table
    top = head.counts[head.ids < head.shared]
    base_space = math.log10(total + 0.1 * (kinds + 1))
    rest_space = math.log10(int(total - top.sum()) + 0.1 * (kinds - len(top) + 1))

    rows = docs.withColumn("k", F.xxhash64("doc_id", "text"))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        codes, own = byte_codes(31), LogBilinear(head.shared, table=table)
        for batch in batches:
            for at, buf, ends in batches_of_bytes(batch.column(3)):
                n = len(ends)
                h, t = tokens_of(buf, ends, codes)
                known, count, word = head.find(h)
                one, two = contexts(word, t, head.shared + 1)
                by_word = own.log_probs(one, two, word) / math.log(10)
                here = np.where(known, np.log10(count + 0.1), 0)
                shared = word == head.shared
                model_sum = np.bincount(t, by_word + np.where(shared, here - rest_space, 0), n)
                rare_w, rare_n = [], []
                rare, bounds = h[~known], np.searchsorted(t[~known], np.arange(n + 1))
                for i in range(n):
                    w, c = np.unique_counts(rare[bounds[i]:bounds[i + 1]]) if bounds[i] < bounds[i + 1] else (h[:0], t[:0])
                    rare_w.append(w.view(np.int64))
                    rare_n.append(c)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(at, n) for i in range(3)), pa.array(np.bincount(t, minlength=n)),
                     pa.array(np.bincount(t, known, n).astype(np.int64)), pa.array(np.bincount(t, here - base_space, n)), pa.array(model_sum),
                     pa.array(rare_w, pa.list_(pa.int64())), pa.array(rare_n, pa.list_(pa.int64()))],
                    ["doc_id", "held_out", "k", "n_tokens", "n_known", "base", "model", "w", "c"])

    scored = materialize(spark, rows.select("doc_id", "held_out", "k", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, k long, n_tokens long, n_known long, base double, model double, w array<long>, c array<long>"), "scored")
    # the counts of the rare words come to their documents
    rare = (scored.select("k", F.explode(F.arrays_zip("w", "c")).alias("r")).select("k", "r.w", "r.c")
            .join(counts, "w", "left").groupBy("k")
            .agg(F.sum(F.col("c") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("more"),
                 F.sum(F.when(F.col("n") > 0, F.col("c")).otherwise(0)).alias("found")))
    copies = scored.groupBy("k").agg(F.count("*").alias("copies"))  # rows of one id and text
    rare = rare.join(copies, "k").select("k", (F.col("more") / F.col("copies")).alias("more"), F.expr("found div copies").alias("found"))
    out = scored.drop("w", "c").join(rare, "k", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(F.col("doc_id").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
                      F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))


ship(__name__)
