"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be met with up to ``rate`` * m edits. Cut into
one piece more than that budget, at least one piece is met unchanged, so an
automaton over all pieces finds every place worth a look in one pass of each
text. A place is dropped if too few of the item's 4-grams occur there (q-gram
lemma, never a true match) and otherwise verified with Myers' bit-parallel
distance, as a substring match.

Items are compared in lower case (A-Z only) and with each white-space character
as a space, which keeps places. They are sent to the tasks in blocks of at most
``block_chars`` characters on average (a pass over the documents each), so what
is broadcast stays small for any benchmark.

Defined results: a null or empty text or item matches nothing; an item whose
budget is 0 matches exactly; repeated items are reported once per row; repeated
documents are reported each; a null id is an id like any other; other columns
are not read. Texts are searched whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import sheltered, ship

FOLD = {**{c: c + 32 for c in range(65, 91)}, **{c: 32 for c in range(9, 14)}}
GRAM = 4


def distance(pattern: str, text: str, free_start: bool = True) -> tuple[int, int]:
    """(least edit distance of the pattern to a part of the text, end of the
    first such part); without ``free_start`` the part begins at 0. Myers'
    bit-parallel recurrence on whole-pattern integers."""
    m = len(pattern)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & mask
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 | (not free_start)
        mh <<= 1
        plus = (mh | ~(xv | ph)) & mask
        minus = ph & xv & mask
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """The items of one block: pieces in an automaton, 4-grams of each item."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        import ahocorasick

        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.budget = [int(len(t) * rate) for t in self.texts]
        self.grams = [[t[i:i + GRAM] for i in range(len(t) - GRAM + 1)] for t in self.texts]
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        for k, (t, e) in enumerate(zip(self.texts, self.budget)):
            for j in range(e + 1):
                a, b = j * len(t) // (e + 1), (j + 1) * len(t) // (e + 1)
                if a < b:
                    pieces.setdefault(t[a:b], []).append((k, a, b - a))
        self.found = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.found.add_word(piece, places)
        self.found.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, distance) of the best match of each item."""
        places: dict[int, list[int]] = {}
        for last, pieces in self.found.iter(text):
            for k, a, size in pieces:
                places.setdefault(k, []).append(last + 1 - size - a)
        out = []
        for k, starts in sorted(places.items()):
            starts.sort()
            e, m = self.budget[k], len(self.texts[k])
            best, lo = None, starts[0]
            for i, s in enumerate(starts):
                # places nearer than the item is long are looked at together
                if i + 1 < len(starts) and starts[i + 1] - s <= m and starts[i + 1] - lo <= 4 * m:
                    continue
                if (hit := self.verify(k, text, max(0, lo - e), min(len(text), s + m + e))) and (best is None or hit[2] < best[2]):
                    best = hit
                lo = starts[i + 1] if i + 1 < len(starts) else 0
            if best:
                out.append((k, *best))
        return out

    def verify(self, k: int, text: str, lo: int, hi: int) -> tuple[int, int, int] | None:
        item, e = self.texts[k], self.budget[k]
        part = text[lo:hi]
        if len(part) < len(item) - e:
            return None
        need = len(self.grams[k]) - GRAM * e
        if need > 0:
            there = {part[i:i + GRAM] for i in range(len(part) - GRAM + 1)}
            if sum(map(there.__contains__, self.grams[k])) < need:
                return None
        d, end = distance(item, part)
        if d > e:
            return None
        back = distance(item[::-1], part[:end][::-1], free_start=False)[1]
        return lo + end - back, lo + end, d


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, keys: list[str], text: str = "text",
            item_key: str = "item_id", item_text: str = "text", rate: float = 0.1, block_chars: int = 1_000_000) -> DataFrame:
    """``keys``, the item's key, start, end (characters, end exclusive) and
    distance of the best match of each item in each row of ``docs``."""
    fold = F.translate(F.col(item_text), "".join(map(chr, FOLD)), "".join(map(chr, FOLD.values())))
    folded = items.select(F.col(item_key).alias("k"), fold.alias("t")).where("length(t) > 0").distinct()
    chars = folded.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), f"`{item_key}` {dict(items.dtypes)[item_key]}", "start long, end long, distance long"])
    rows = docs.select(*keys, text)
    if not blocks:
        return spark.createDataFrame([], schema)
    out = None
    for b in range(blocks):
        block = [tuple(r) for r in folded.where(F.pmod(F.xxhash64("t", "k"), F.lit(blocks)) == b).collect()]  # about block_chars characters
        part = rows.mapInArrow(searcher(sorted(block, key=lambda r: (str(r[0]), r[1])), rate, [*keys, item_key]), schema)
        out = part if out is None else out.unionByName(part)
    return out


def searcher(block: list, rate: float, names: list[str]):
    def run(batches):
        items = Items(block, rate)
        n = len(names) - 1
        for batch in batches:
            at, hits = [], []
            for i, t in enumerate(batch.column(n).to_pylist()):
                for hit in items.search((t or "").translate(FOLD)) if items.ids else ():
                    at.append(i)
                    hits.append(hit)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(rows) for i in range(n)), pa.array(items.ids).take(pa.array([h[0] for h in hits], pa.int64())),
                 *(pa.array([h[i] for h in hits], pa.int64()) for i in (1, 2, 3))], [*names, "start", "end", "distance"])

    return run


@sheltered
def drop_matches(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is met; all columns."""
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    bad = (matches(spark, rows, items, ["doc_id", "__hash"])
           .select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__th")).distinct())
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th"))
    return rows.join(bad.hint("shuffle_hash"), on, "left_anti").select(*docs.columns)


ship(__name__)
