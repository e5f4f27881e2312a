"""Detection of periodic runs of words by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of at least ``max(least, times * q)`` words, that no
neighbouring word extends. On the diagonal of lag q a run is an unbroken row of
matches; each word's earlier occurrences lengthen the matches of their lags, and
a diagonal that breaks with enough matches gives its run at once.

The DP is sparse in the occurrences it looks at. Lags in (L/2, L], L a power of
two, are served by the word with its L - 1 followers (its gram). A run of
smallest period q has more than L matches on its diagonal, and within it two
equal stretches of q words or more lie a multiple of q apart (its root is
primitive), so at every place of the run the nearest earlier occurrence of the
gram is exactly q back; farther ones belong to no run of these lags. Conversely
an unbroken row of places with one nearest lag q and enough matches has no
smaller period, which would have given a nearer occurrence. So each place
lengthens one diagonal for each L: O(n log n) steps in all, whatever repeats.
Grams that occur once in a text are dropped before L doubles. Word numbers and
gram numbers are exact, no hashes.

Defined results: a null text is empty; a text without words has no run and
collapses to the empty text; texts are taken whole, very long ones too (memory
is in proportion to the longest text); of equal extents the smallest period is
the run's (a text has each run once); repeated rows give repeated rows, a null
id is an id like any other; the table may be empty; other columns are not read.
"""

from __future__ import annotations

from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import NOT_SPACE, chunks, let, ship

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def runs_of(words: np.ndarray, ends: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of texts that lie one after another:
    ``words`` are word numbers, ``ends`` the texts' ends."""
    sizes = np.diff(np.concatenate(([0], ends)))
    begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    found = [np.zeros((3, 0), np.int64)]
    place, name, size = np.arange(len(words)), words, 1  # grams of `size` words and where they begin
    while len(place):
        order = np.argsort(name, kind="stable")
        at, gram = place[order], name[order]
        again = (gram[1:] == gram[:-1]) & (at[:-1] >= begin[at[1:]])  # occurs earlier in its text
        here, lag = at[1:][again], (at[1:] - at[:-1])[again]
        near = (lag <= size) & (2 * lag > size)
        here, lag = here[near], lag[near]
        order = np.argsort(here)
        here, lag = here[order], lag[order]
        # a diagonal goes on while the next place has the same lag
        first = np.flatnonzero(np.concatenate(([True], (np.diff(here) != 1) | (np.diff(lag) != 0)))) if len(here) else here
        period = lag[first]
        length = np.diff(np.append(first, len(here))) + size - 1 + period
        start = here[first] - period
        good = length >= np.maximum(least, times * period)
        found.append(np.stack((start[good], length[good], period[good])))
        # both halves of a longer gram occur twice
        twice = np.zeros(len(at), bool)
        twice[1:] |= again
        twice[:-1] |= again
        number = np.full(len(words) + size, -1)
        number[at[twice]] = np.cumsum(np.concatenate(([True], gram[1:] != gram[:-1])))[twice]
        place = np.sort(at[twice])
        place = place[(place + 2 * size <= end[place]) & (number[place + size] >= 0)]
        place = place[end[place] - begin[place] >= times * (size + 1)]
        name = number[place] * (len(words) + 1) + number[place + size]
        size *= 2
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``key``, n_words, runs (array of start, length, period in words, sorted
    by start, then period) and collapsed: the words that no run holds after its
    first period, joined by one space. ``times`` is at least 3: the DP looks at
    nearest occurrences only."""
    if times < 3:
        raise ValueError("times must be at least 3")
    kind = dict(docs.dtypes)[key]
    out = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at, rows in chunks(texts):
                parts = [(t or "").encode().split() for t in texts.slice(at, rows).to_pylist()]
                ends = np.cumsum([len(p) for p in parts])
                numbers: dict[bytes, int] = {}
                words = np.fromiter(map(numbers.setdefault, chain.from_iterable(parts), count()), np.int64, int(ends[-1]))
                start, length, period = runs_of(words, ends, least, times)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                kept = np.cumsum(edge)[:-1] == 0
                of = np.searchsorted(start, np.concatenate(([0], ends)))
                begins = np.concatenate(([0], ends[:-1]))
                texts_of = np.repeat(np.arange(rows), np.diff(of))
                collapsed = [b" ".join(p if a == b else compress(p, kept[s:s + len(p)]))
                             for p, s, a, b in zip(parts, begins.tolist(), of[:-1].tolist(), of[1:].tolist())]
                spans = pa.StructArray.from_arrays([pa.array(x) for x in (start - begins[texts_of], length, period)], fields=list(out))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, rows), pa.array(ends - begins), pa.ListArray.from_arrays(pa.array(of, pa.int32()), spans),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], ["k", "n_words", "runs", "collapsed"])

    return (docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
            .mapInArrow(run, f"k {kind}, n_words long, runs array<{RUN}>, collapsed string").withColumnRenamed("k", key))


def digest(runs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the run of greatest length/period (ties: smallest start,
    then period) and digests of all runs and of the collapsed text."""
    none = F.lit(None).cast(RUN)
    top = F.aggregate("runs", none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (runs.withColumn("top", top)
            .select(key, F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                    F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def looped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text`` of all rows; in texts whose id has crc32 h with
    h % 10 = 0 each word i >= a becomes original word a + (i - a) % p, with
    a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), g = floor(h / 10), n words.
    A text with a null id stays as it is."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))

    def repeat(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10)

        def fill(at: Column) -> Column:
            a, p = at["a"], at["p"]
            moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
            return F.array_join(moved, " ")

        a = g % n
        return F.when(n > 0, let(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")), fill))

    words = F.regexp_extract_all(F.col(text), F.lit(f"{NOT_SPACE}+"), F.lit(0))
    return docs.select(F.col(key), F.when(h % 10 == 0, F.coalesce(let(words, repeat), F.col(text))).otherwise(F.col(text)).alias(text))


ship(__name__)
