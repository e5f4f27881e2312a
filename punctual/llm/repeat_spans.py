"""Removal of long repeated byte strings with suffix order and
longest-previous-factor (LPF) arrays.

A string of ``length`` bytes that occurs twice contains the same least k-gram
(its anchor) at the same place in both occurrences. Each text is cut into runs
of neighbouring windows with one anchor; runs with equal bytes are equal
everywhere, so hashes of anchor and run bytes settle the inside of shared
passages by counting. Only where runs share the anchor but differ (at the edges
of shared passages) are the bytes compared: one copy of each different run goes
to the task of its anchor, which sorts the suffixes, takes the common prefixes
of neighbours and, from the previous and next smaller positions in suffix
order, the longest match that starts earlier (``lpf``) and, mirrored, the
longest that starts later. The runs of an anchor with many different
ones (one common line in very many texts) are first split by further grams: a
run is cut into four by how far its windows begin before the anchor, and all
windows of a piece hold the same longer gram around the anchor, by which pieces
meet again. Pieces whose gram is found once are done, equal ones are settled by
counting as runs are, and those that still differ are split again (four times at
most, when the gram is the whole window) until no gram has many different ones.
So no group in one task grows with the table.

``keep_first`` keeps the first occurrence (by document id, then place) of each
repeated string; without it every byte of a repeated string goes. Strings are
judged on the input, never on what is left.

Defined results: a null text is empty; texts shorter than ``length`` lose
nothing; rows repeated with one id are copies of each other like any others; a
null id sorts first; the table may be empty; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import batches_of_bytes, byte_codes, materialize, mix, ship

GRAM = 40
HOT = 256            # more different runs of one anchor than this are split by further grams
SEGMENT = 1 << 18    # window starts looked at together
ROOM = 4_000_000     # bytes of text held together when ranges are cut out
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 24) - 1)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 2 * SEGMENT)
        _POWERS[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, np.uint64(base))
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


class Prefix:
    """Hashes of any byte range of a buffer."""

    def __init__(self, buf: np.ndarray, codes: np.ndarray):
        up, self.down = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(codes[buf] * up[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def runs_of(buf: np.ndarray, ends: np.ndarray, length: int, codes: np.ndarray):
    """(text, first window, windows, anchor hash, run hash) of every run; no
    window spans two texts of ``buf``."""
    width = length - GRAM + 1
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none
    text_end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))
    valid = np.arange(n) + length <= text_end[:n]
    if not valid.any():
        return none, none, none, none, none
    hashes = Prefix(buf, codes)
    at = np.arange(len(buf) - GRAM + 1)
    grams = mix(hashes.of(at, at + GRAM))
    packed = (grams & ~_PLACE) | at.astype(np.uint64)  # ties go to the left
    pad = -len(packed) % width
    block = np.concatenate((packed, np.full(pad, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(block, axis=1).ravel()
    least = np.minimum(ahead[:n], behind[width - 1:width - 1 + n])
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    lo = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.concatenate((~valid[1:] | new[1:], [True]))) + 1
    anchor = (least[lo] & _PLACE).astype(np.int64)
    count = stop - lo
    shape = mix((anchor - lo).astype(np.uint64) * np.uint64(1 << 32) + count.astype(np.uint64))
    whole = mix(hashes.of(lo, stop - 1 + length) + shape)
    return np.searchsorted(ends, lo, side="right"), lo, count, grams[anchor].view(np.int64), whole.view(np.int64)


def segments(buf: np.ndarray, ends: np.ndarray, length: int):
    """(offset, part, ends) of parts with at most SEGMENT window starts each; a
    text longer than that is cut into parts that overlap by length - 1 bytes."""
    if len(buf) <= SEGMENT + length:
        yield 0, buf, ends
        return
    starts = np.concatenate(([0], ends[:-1]))
    for a, b in zip(starts.tolist(), ends.tolist()):
        for s in range(a, max(b - length + 1, a + 1), SEGMENT):
            e = min(b, s + SEGMENT + length - 1)
            yield s, buf[s:e], np.array([e - s])


def scan(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, th, a (anchor), b (run), lo, n of every run of every text."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        codes = byte_codes(23)
        for batch in batches:
            for at, buf, ends in batches_of_bytes(batch.column(2), SEGMENT):
                starts = np.concatenate(([0], ends[:-1]))
                for off, part, stop in segments(buf, ends, length):
                    text, lo, n, a, b = runs_of(part, stop, length, codes)
                    if not len(lo):
                        continue
                    if off or len(stop) != len(ends):
                        text = np.full(len(lo), np.searchsorted(ends, off, side="right"))
                    rows = pa.array(text + at)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(a), pa.array(b),
                         pa.array((lo + off - starts[text]).astype(np.int32)), pa.array(n.astype(np.int32))],
                        ["doc_id", "th", "a", "b", "lo", "n"])

    return docs.mapInArrow(run, f"doc_id {kind}, th long, a long, b long, lo int, n int")


# ---------------------------------------------------------------- suffix order

def suffix_levels(buf: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes by their first 1, 8, 16, ... and ``length`` bytes
    (prefix doubling); equal ranks mean equal prefixes. The end of the buffer
    sorts first."""
    n = len(buf)
    out = [(1, buf.astype(np.int64) + 1)]
    key = np.zeros(n, np.uint64)
    wide = np.concatenate((buf, np.zeros(8, np.uint8))).astype(np.uint64)
    for k in range(min(8, length)):
        key = key << np.uint64(8) | wide[k:n + k]
    h = min(8, length)
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    while True:
        out.append((h, rank))
        if h >= length:
            return out
        step = min(h, length - h)
        after = np.zeros(n, np.int64)
        if step < n:
            after[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        h += step


def common_prefix(levels, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of the suffixes at i and j, ``length`` at most."""
    full = levels[-1][1]
    n = len(full)
    same = full[i] == full[j]
    out = np.where(same, length, 0)
    i, j = i.copy(), j.copy()
    for h, rank in [(h, r) for h, r in levels[::-1] if h < length for _ in range(8 if h == 1 else 2)]:
        ok = ~same & (i < n) & (j < n) & (out + h <= length)
        ok[ok] = rank[i[ok]] == rank[j[ok]]
        out[ok] += h
        i[ok] += h
        j[ok] += h
    return out


def smaller_before(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each rank the common prefix with the nearest lower rank whose suffix
    starts at a smaller position (0 if none): pointer jumping over ``common``,
    the common prefix of each rank with the one before it."""
    to = np.arange(len(place)) - 1
    best = common.copy()
    todo = np.flatnonzero(to >= 0)
    while len(todo):
        todo = todo[place[to[todo]] > place[todo]]
        best[todo] = np.minimum(best[todo], best[to[todo]])
        to[todo] = to[to[todo]]
        todo = todo[to[todo] >= 0]
    best[to < 0] = 0
    return best


def factors(buf: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``starts`` (increasing): the longest match of its suffix with one
    of them that starts earlier (LPF), and with any other of them, earlier or later
    (the greater of LPF and its mirror); ``length`` at most."""
    if not len(starts):
        return starts, starts
    levels = suffix_levels(buf, length)
    order = np.argsort(levels[-1][1][starts], kind="stable")
    place = starts[order]
    common = np.zeros(len(place), np.int64)
    common[1:] = common_prefix(levels, place[1:], place[:-1], length)
    after = np.append(common[1:], 0)
    lpf, lff = np.empty_like(common), np.empty_like(common)
    for out, key in ((lpf, place), (lff, -place)):
        out[order] = np.maximum(smaller_before(key, common), smaller_before(key[::-1], after[::-1])[::-1])
    return lpf, np.maximum(lpf, lff)


def repeated(blocks: list[bytes], counts: list[int], length: int, keep_first: bool) -> list[list[tuple[int, int]]]:
    """The repeated windows of each block as (first, end) ranges; the blocks are
    in the order of their places, block i has windows 0 ... counts[i] - 1."""
    buf = np.frombuffer(b"".join(blocks), np.uint8)
    begin = np.cumsum([0, *map(len, blocks)])
    own = np.repeat(np.arange(len(blocks)), counts)
    first = np.cumsum([0, *counts])
    starts = begin[own] + np.arange(len(own)) - first[own]
    lpf, other = factors(buf, starts, length)
    hit = (lpf if keep_first else other) >= length
    return [ranges(hit[first[i]:first[i + 1]]) for i in range(len(blocks))]


def ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


# ---------------------------------------------------------------- Spark side

def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, th and the text's UTF-8 bytes, compressed for the shuffle."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for at, buf, ends in batches_of_bytes(batch.column(2)):
                z = [pack(buf[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                some = slice(at, at + len(z))
                yield pa.RecordBatch.from_arrays([batch.column(0)[some], batch.column(1)[some], pa.array(z, pa.binary())], ["doc_id", "th", "z"])

    return docs.mapInArrow(run, f"doc_id {kind}, th long, z binary")


def at_texts(texts: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """Join compressed texts with one small row per document (the built side)."""
    right = per_doc.withColumnsRenamed({"doc_id": "_d", "th": "_t"}).hint("shuffle_hash")
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("th").eqNullSafe(F.col("_t"))
    return texts.join(right, on, how).drop("_d", "_t")


def block_bytes(rows: DataFrame, length: int) -> DataFrame:
    """doc_id, th, a, b, lo, n and bytes of the runs listed per document."""
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for d, t, z, runs in zip(*(batch.column(i) for i in range(4))):
                text = unpack(z.as_py())
                runs = runs.as_py()
                for i in range(0, len(runs), 2000):
                    part = runs[i:i + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d.as_py()] * len(part), d.type), pa.array([t.as_py()] * len(part), pa.int64()),
                         *(pa.array([r[k] for r in part], pa.int64()) for k in ("a", "b")),
                         *(pa.array([r[k] for r in part], pa.int32()) for k in ("lo", "n")),
                         pa.array([text[r["lo"]:r["lo"] + r["n"] + length - 1] for r in part], pa.binary())],
                        ["doc_id", "th", "a", "b", "lo", "n", "bytes"])

    return rows.select("doc_id", "th", "z", "runs").mapInArrow(run, f"doc_id {kind}, th long, a long, b long, lo int, n int, bytes binary")


def compare(blocks: DataFrame, length: int, keep_first: bool, room: int = 400_000) -> DataFrame:
    """doc_id, th, s, e (repeated windows) of the runs of cold anchors: each
    anchor's runs come to one task, a bounded number of bytes at a time."""
    kind = dict(blocks.dtypes)["doc_id"]
    cols = ["doc_id", "th", "a", "lo", "n", "bytes"]

    def run(batches):
        held, size = [], 0

        def flush():
            hits = repeated([r[5] for r in held], [r[4] for r in held], length, keep_first)
            out = [(r[0], r[1], r[3] + s, r[3] + e) for r, hit in zip(held, hits) for s, e in hit]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((key, pa.int64(), pa.int32(), pa.int32()))], ["doc_id", "th", "s", "e"])

        for batch in batches:
            key = batch.schema.field(0).type
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(cols)))):
                if size >= room and held[-1][2] != row[2]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield flush()

    dealt = blocks.select(*cols).repartition(F.col("a")).sortWithinPartitions("a", "doc_id", "th", "lo")
    return dealt.mapInArrow(run, f"doc_id {kind}, th long, s int, e int")


def least_gram(buf: np.ndarray, length: int, hashes: Prefix) -> int:
    """Where the anchor of the first window of ``buf`` begins."""
    at = np.arange(length - GRAM + 1)
    return int(np.argmin(mix(hashes.of(at, at + GRAM)) & ~_PLACE))  # ties go to the left


def cuts(buf: np.ndarray, n: int, p: int, x: int, y: int, length: int, hashes: Prefix):
    """(first window, windows, x, y, gram hash, hash) of the pieces of a run of ``n``
    windows with the anchor at ``p``, which begin x to y bytes before the anchor."""
    step = -(-(y - x + 1) // 4)
    for u in range(x, y + 1, step):
        v = min(y, u + step - 1)
        i, j = max(0, p - v), min(n - 1, p - u)  # window i begins p - i bytes before the anchor
        if i <= j:
            both = hashes.of(np.array([p - u, i]), np.array([p - v + length, j + length]))
            shape = np.array([u * 1024 + v + 1, (p - i) * 1024 + j - i + 1], np.uint64)
            gram, whole = mix(both + mix(shape))
            yield i, j - i + 1, u, v, gram, whole


def split(blocks: DataFrame, length: int) -> DataFrame:
    """The pieces of the runs in ``blocks``, as rows like those: a is the hash of the
    gram that all windows of a piece hold, b that of the piece."""
    fields = blocks.schema.fieldNames()

    def run(batches):
        codes = byte_codes(23)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                buf = np.frombuffer(r["bytes"], np.uint8)
                hashes = Prefix(buf, codes)
                p = r["p"] if r["p"] is not None else least_gram(buf, length, hashes)
                for i, n, x, y, gram, whole in cuts(buf, r["n"], p, r["x"], r["y"], length, hashes):
                    a = mix(np.array([r["a"]], np.int64).view(np.uint64) + gram).view(np.int64)[0]
                    out.append(r | {"a": int(a), "b": int(whole.view(np.int64)), "lo": r["lo"] + i, "n": n, "p": p - i,
                                    "x": x, "y": y, "bytes": r["bytes"][i:i + n - 1 + length]})
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema=batch.schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return blocks.select(*fields).mapInArrow(run, blocks.schema)


def settle(spark: SparkSession, runs: DataFrame, keep_first: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, s, e of the windows that counting equal runs settles; one copy of
    each run that shares its anchor with a different one, with how many there are)."""
    shared = (runs.groupBy("a").agg(F.count("*").alias("k"), F.min("b").alias("x0"), F.max("b").alias("y0"))
              .where("k > 1").select("a", (F.col("x0") == F.col("y0")).alias("same")))
    met = materialize(spark, runs.join(shared, "a"), "runs")
    spot = ["doc_id", "th", "lo"]
    place = F.struct(*spot, *(c for c in runs.columns if c not in (*spot, "a", "b")))
    different = met.where("NOT same") if not keep_first else met
    blocks = materialize(spark, different.groupBy("a", "b").agg(F.count("*").alias("k"), F.min(place).alias("at"), F.first("same").alias("same")), "blocks")
    whole = ["doc_id", "th", F.col("lo").alias("s"), (F.col("lo") + F.col("n")).alias("e")]

    again = blocks.where("k > 1").select("a", "b", F.struct(*(F.col(f"at.{c}") for c in spot)).alias("first"))
    copies = met.join(again, ["a", "b"])
    if keep_first:
        out = copies.where(~F.struct(*spot).eqNullSafe(F.col("first"))).select(*whole)
    else:
        out = met.where("same").select(*whole).unionByName(copies.select(*whole))
    mixed = blocks.where("NOT same")
    crowd = mixed.groupBy("a").agg(F.count("*").alias("different"))
    return out, mixed.join(crowd, "a").select("at.*", "a", "b", "different")


def repeated_ranges(spark: SparkSession, docs: DataFrame, texts: DataFrame, length: int, keep_first: bool, hot: int = HOT) -> DataFrame:
    """doc_id, th, s, e: windows (by first byte) to remove, as ranges."""
    out, mixed = settle(spark, scan(docs, length), keep_first)

    def with_bytes(which: Column) -> DataFrame:
        listed = (mixed.where(which).groupBy("doc_id", "th")
                  .agg(F.collect_list(F.struct("a", "b", "lo", "n")).alias("runs")))
        return block_bytes(at_texts(texts, listed, "inner"), length)

    few = F.col("different") <= hot
    out = out.unionByName(compare(with_bytes(few), length, keep_first))
    if mixed.where(~few).isEmpty():
        return out
    parts = with_bytes(~few).select("*", *(F.lit(v).cast("int").alias(c) for c, v in (("p", None), ("x", 0), ("y", length - GRAM))))
    while True:
        equal, mixed = settle(spark, split(parts, length), keep_first)
        out = out.unionByName(equal).unionByName(compare(mixed.where(few), length, keep_first))
        parts = mixed.where(~few).drop("different")
        if parts.isEmpty():
            return out


def remove_repeats(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200,
                   keep_first: bool = True, full: bool = True) -> DataFrame:
    """One row per row of ``docs``: the key, n_bytes, n_removed, n_spans,
    kept_sha256; with ``full`` also the removed ``spans`` (bytes, end exclusive)
    and what is left (``kept``, bytes)."""
    docs = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    texts = packed_texts(docs)
    found = repeated_ranges(spark, docs, texts, length, keep_first)
    per_doc = found.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("r"))
    rows = at_texts(texts, per_doc, "left").select("doc_id", "z", F.col("r.s").alias("s"), F.col("r.e").alias("e"))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", spans array<struct<start:long,end:long>>, kept binary" if full else "")

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        def together(at: int, out: list, ids: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids[at:at + len(out)], *(pa.array([r[i] for r in out], types[i]) for i in range(len(names)))], ["doc_id", *names])

        types = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][:6 if full else 4]
        for batch in batches:
            out, at, size = [], 0, 0
            for z, s, e in zip(*(batch.column(i) for i in (1, 2, 3))):
                data = unpack(z.as_py())
                spans: list[list[int]] = []
                for a, b in zip(s.as_py() or (), e.as_py() or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b - 1 + length)
                    else:
                        spans.append([a, b - 1 + length])
                ends = [0, *(x for span in spans for x in span), len(data)]
                parts = [data[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2)] if spans else [data]
                sha = hashlib.sha256()
                for part in parts:
                    sha.update(part)
                removed = sum(b - a for a, b in spans)
                row = (len(data), removed, len(spans), sha.hexdigest())
                out.append((*row, [{"start": a, "end": b} for a, b in spans], b"".join(parts)) if full else row)
                size += len(data)
                if size >= ROOM:
                    yield together(at, out, batch.column(0))
                    out, at, size = [], at + len(out), 0
            yield together(at, out, batch.column(0))

    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", key)


ship(__name__)
