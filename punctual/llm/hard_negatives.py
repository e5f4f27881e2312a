"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integer vectors (floor(scale * x)), are ordered along a Hilbert
curve over their widest dimensions and written as Parquet blocks (one row per
block) with the least and greatest value of every dimension. Interval arithmetic
on those zone maps bounds the inner product of an anchor with any row of a
block from both sides; an anchor reads only blocks whose bounds meet a window of
scores it still wants.

A search runs in two rounds. First each window reads the few blocks whose upper
bounds are best for it; what it finds there (score and id of its last place) is a
bar, and the second round reads the blocks that can still pass the bar. Anchors
travel to blocks in batches (the anchors of one block): blocks and requests are
dealt by block and sorted so that a task holds one block and streams its
requests; a block's requests are never gathered. Each answers with the few best
rows, which a window function brings together.

Zone maps are collected: blocks grow with the table so that all zone maps take at
most ``ZONE_BYTES``.

Defined results: rows with a null label or vector or a null or non-finite
component take no part; vectors of unequal length are compared as if filled
with zeros; a null id is never an anchor and comes after all others in ties; a
repeated row is another row (also as a positive of its copy) and a repeated
anchor gives repeated results; components and scores beyond 2**61 saturate
there; the table may be empty; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.llm.common import materialize, ship

LIMIT = 1 << 61           # greatest absolute value of a component or a score
LAST = (1 << 63) - 1      # stands for a null id in ties
ZONE_BYTES = 32_000_000
AXES, BITS = 8, 6         # dimensions and bits of each on the Hilbert curve

BLOCK = "block long, ids array<bigint>, labels array<bigint>, places array<int>, code int, data binary, lo array<bigint>, hi array<bigint>"
WANT = "array<struct<place:int,k:int,low:bigint,high:bigint,bar:bigint,bar_id:bigint>>"
FOUND = "batch long, place int, k int, anchor_id long, score long, id long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (values below
    2**bits): the axes are turned into the transposed index, whose bits are then
    interleaved."""
    axes = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        side, low = 1 << level, (1 << level) - 1
        for i, x in enumerate(axes):
            upper = (x & side) != 0
            swap = np.where(upper, 0, (axes[0] ^ x) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] ^ swap if i else axes[0]
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for x in axes:
            key = key << 1 | ((x ^ turn) >> bit & 1)
    return key


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < LIMIT:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -LIMIT, LIMIT).astype(np.int64)


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that each row of ``a`` can have with a
    vector between ``lo`` and ``hi`` of each block."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of a list column, filled with zeros."""
    lens = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lens[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def unpack(data: bytes, code: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{code}").astype(np.int64).reshape(rows, -1)


def packed(values: np.ndarray) -> tuple[int, bytes]:
    top = int(np.abs(values).max(initial=0))
    code = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return code, values.astype(f"<i{code}").tobytes()


def integers(rows: DataFrame, vector_id: Column, label: Column, vector: Column, anchor: Column, scale: int) -> DataFrame:
    """id, label, anchor, v of the rows that take part."""
    odd = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("x", lambda x: F.least(F.greatest(F.floor(x * scale), F.lit(-LIMIT)), F.lit(LIMIT)))
    return (rows.select(vector_id.cast("long").alias("id"), label.cast("long").alias("label"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"), vector.cast("array<double>").alias("x"))
            .where(F.col("label").isNotNull() & F.col("x").isNotNull() & ~odd)
            .select("id", "label", F.col("anchor") & F.col("id").isNotNull(), whole.alias("v")).toDF("id", "label", "anchor", "v"))


def spread_of(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, mean and standard deviation of each dimension."""
    def sums(batches):
        n, s = 0, np.zeros((2, 0))
        for batch in batches:
            column = batch.column(0)
            dims = max(s.shape[1], int(np.diff(column.offsets.to_numpy()).max(initial=0)))
            m = matrix(column, dims).astype(np.float64)
            s = np.pad(s, ((0, 0), (0, dims - s.shape[1]))) + np.stack((m.sum(0), (m * m).sum(0)))
            n += len(m)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, s.shape[1])), pa.array(np.append(n, s[0]).astype(float)), pa.array(np.append(0, s[1]))], ["d", "s", "q"])

    total = rows.select("v").mapInArrow(sums, "d long, s double, q double").groupBy("d").agg(F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("d").collect()
    n = int(total[0].s) if total else 0
    s, q = (np.array([r[c] for r in total[1:]]) / max(n, 1) for c in ("s", "q"))
    return n, s, np.sqrt(np.maximum(q - s * s, 0))


@dataclass
class Zones:
    """Zone maps of all blocks (bounded, see ``ZONE_BYTES``)."""

    block: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    bits: np.ndarray   # labels modulo 64 that the block holds
    only: np.ndarray   # its label, where it has just one
    single: np.ndarray

    def eligible(self, labels: np.ndarray, same: bool) -> np.ndarray:
        if same:
            return (self.bits >> (labels[:, None] % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
        return ~(self.single & (self.only == labels[:, None]))


def write_blocks(spark: SparkSession, rows: DataFrame, block_rows: int) -> tuple[DataFrame, Zones] | None:
    """Hilbert-ordered Parquet blocks and their zone maps; None without rows."""
    n, mean, dev = spread_of(rows)
    if n == 0:
        return None
    dims = len(mean)
    block_rows = max(block_rows, -(-n * 16 * max(dims, 1) // ZONE_BYTES))
    axes = np.sort(np.argsort(-dev, kind="stable")[:AXES])

    def add_key(batches):
        for batch in batches:
            m = matrix(batch.column(3), dims)[:, axes]
            width = np.maximum(dev[axes], 1e-9)
            cells = np.clip((m - mean[axes] + 2 * width) / (4 * width) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            key = hilbert(cells, BITS) if len(axes) else np.zeros(len(m), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], ["key", "id", "label", "anchor", "v"])

    def pack(batches):
        ids, labels, anchors, parts, seq = [], [], [], [], 0
        here = TaskContext.get().partitionId() << 24

        def block(k: int):
            nonlocal ids, labels, anchors, parts, seq
            m = np.concatenate(parts)
            code, data = packed(m[:k])
            out = [here + seq], [ids[:k]], [labels[:k]], [np.flatnonzero(anchors[:k])], [code], [data], [m[:k].min(0)], [m[:k].max(0)]
            ids, labels, anchors, parts, seq = ids[k:], labels[k:], anchors[k:], [m[k:]], seq + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (
                pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                ["block", "ids", "labels", "places", "code", "data", "lo", "hi"])

        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                some = batch.slice(at, block_rows)
                ids += some.column(1).to_pylist()
                labels += some.column(2).to_pylist()
                anchors += some.column(3).to_pylist()
                parts.append(matrix(some.column(4), dims))
                while len(ids) >= block_rows:
                    yield block(block_rows)
        if ids:
            yield block(len(ids))

    kind = "id long, label long, anchor boolean, v array<bigint>"
    ordered = (rows.mapInArrow(add_key, f"key long, {kind}")
               .repartitionByRange(max(1, n // (8 * block_rows)), "key", "id").sortWithinPartitions("key", "id", "label"))
    blocks = materialize(spark, ordered.mapInArrow(pack, BLOCK), "blocks")
    bit = F.aggregate("labels", F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int"))))
    z = blocks.select("block", "lo", "hi", bit.alias("bits"), F.array_min("labels").alias("a"), F.array_max("labels").alias("b")).orderBy("block").collect()
    return blocks, Zones(np.array([r.block for r in z]), np.array([r.lo for r in z], np.int64).reshape(len(z), dims),
                         np.array([r.hi for r in z], np.int64).reshape(len(z), dims), np.array([r.bits for r in z], np.int64).astype(np.uint64),
                         np.array([r.a for r in z]), np.array([r.a == r.b for r in z]))


def anchors_of(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    """The anchors of each block: places, ids, labels, code, data."""
    def take(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = r["places"]
                code, data = packed(unpack(r["data"], r["code"], len(r["ids"]))[at])
                yield pa.RecordBatch.from_pylist([{"batch": r["block"], "places": at, "ids": [r["ids"][i] for i in at],
                                                   "labels": [r["labels"][i] for i in at], "code": code, "data": data}], kind)

    kind = pa.schema([("batch", pa.int64()), ("places", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())),
                      ("labels", pa.list_(pa.int64())), ("code", pa.int32()), ("data", pa.binary())])
    some = blocks.where(F.size("places") > 0).select("block", "places", "ids", "labels", "code", "data")
    return materialize(spark, some.mapInArrow(take, "batch long, places array<int>, ids array<bigint>, labels array<bigint>, code int, data binary"), "anchors")


def fields(wants: pa.StructScalar | list, places: list[int]) -> tuple:
    """Row of each want's anchor, and the wants' k, low, high, bar, bar_id."""
    w = wants.values
    place, *rest = (w.field(name).to_numpy(zero_copy_only=False) for name in ("place", "k", "low", "high", "bar", "bar_id"))
    return np.searchsorted(np.array(places), place), place, *rest


def probe(blocks: DataFrame, batches: DataFrame, zones: Zones, wants: DataFrame, same: bool, limit: int, seeds: int | None) -> DataFrame:
    """One round: the best ``limit`` rows of each want in each block it reads;
    the best ``seeds`` blocks of each want, or all that its bounds allow."""
    def choose(rows):
        for batch in rows:
            need = []
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).drop_columns(["wants"]).to_pylist()[0]
                at, _, _, low, high, bar, _ = fields(batch.column("wants")[i], r["places"])
                a = unpack(r["data"], r["code"], len(r["ids"]))
                least, most = bounds(a, zones.lo, zones.hi)
                ok = zones.eligible(np.array(r["labels"])[at], same) & (most[at] >= np.maximum(low, bar)[:, None]) & (least[at] <= high[:, None])
                if seeds is not None and ok.shape[1] > seeds:
                    reach = np.where(ok, np.minimum(most[at], high[:, None]), -2 * LIMIT)
                    best = np.argsort(-reach, axis=1, kind="stable")[:, :seeds]
                    first = np.zeros_like(ok)
                    np.put_along_axis(first, best, True, axis=1)
                    ok &= first
                need.append(zones.block[ok.any(0)].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(need, pa.list_(pa.int64()))], [*batch.schema.names, "need"])

    def score(rows):
        held, out, size = None, [], 0
        for batch in rows:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).drop_columns(["wants"]).to_pylist()[0]
                if r["batch"] is None:
                    ids = np.array([LAST if x is None else x for x in r["ids"]])
                    held = r["block"], ids, np.array([x is None for x in r["ids"]]), np.array(r["labels"]), unpack(r["data"], r["code"], len(ids))
                    continue
                block, ids, missing, labels, b = held
                at, place, k, low, high, bar, bar_id = fields(batch.column("wants")[i], r["places"])
                own = np.array(r["labels"])
                s = products(unpack(r["data"], r["code"], len(own)), b)
                like = labels == own[:, None]
                fit = like if same else ~like
                if same and r["batch"] == block:  # a row is not its own positive
                    fit[np.arange(len(own)), r["places"]] = False
                of = s[at]
                good = fit[at] & (of >= low[:, None]) & (of <= high[:, None]) & ((of > bar[:, None]) | (of == bar[:, None]) & (ids <= bar_id[:, None]))
                w, c = np.nonzero(good)
                if not len(w):
                    continue
                order = np.lexsort((ids[c], -of[w, c], w))
                w, c = w[order], c[order]
                first = np.searchsorted(w, w)
                near = np.arange(len(w)) - first < limit
                w, c = w[near], c[near]
                out.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(w), r["batch"])), pa.array(place[w]), pa.array(k[w]), pa.array(np.array(r["ids"])[at[w]]),
                     pa.array(of[w, c]), pa.array(ids[c], mask=missing[c])], ["batch", "place", "k", "anchor_id", "score", "id"]))
                size += len(w)
                if size > 20_000:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                    out, size = [], 0
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    columns = ["block", "batch", "places", "ids", "labels", "code", "data", "wants"]
    lists = wants.groupBy("batch").agg(F.collect_list(F.struct("place", "k", "low", "high", "bar", "bar_id")).cast(WANT).alias("wants"))
    asked = lists.join(batches, "batch")
    requests = (asked.mapInArrow(choose, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema) + ", need array<bigint>")
                .withColumn("block", F.explode("need")).select(*columns))
    held = blocks.select("block", F.lit(None).cast("long").alias("batch"), F.lit(None).cast("array<int>").alias("places"), "ids", "labels", "code", "data",
                         F.lit(None).cast(WANT).alias("wants"))
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (held.unionByName(requests).repartition(parts, "block").sortWithinPartitions("block", F.col("batch").asc_nulls_first())
            .mapInArrow(score, FOUND))


def best(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of each want, by score, then id."""
    w = Window.partitionBy("batch", "place", "k").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def search(blocks: DataFrame, batches: DataFrame, zones: Zones, wants: DataFrame, same: bool, limit: int, seeds: int) -> DataFrame:
    """Both rounds: the first ``limit`` rows of every want, among those of its
    anchor's label or of other labels."""
    open_bar = {"bar": F.lit(-LIMIT), "bar_id": F.lit(LAST)}
    first = best(probe(blocks, batches, zones, wants.withColumns(open_bar), same, limit, seeds), limit).where(F.col("rank") == limit)
    bars = first.select("batch", "place", "k", F.col("score").alias("bar"), F.coalesce("id", F.lit(LAST)).alias("bar_id"))
    told = wants.join(bars, ["batch", "place", "k"], "left").withColumns({c: F.coalesce(c, v) for c, v in open_bar.items()})
    return best(probe(blocks, batches, zones, told, same, limit, None), limit)


def mine(spark: SparkSession, rows: DataFrame, vector_id: Column, label: Column, vector: Column, anchor: Column, scale: int = 256,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_rows: int = 2048, seeds: int = 2) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of its label, the
    first ``negatives`` rows of other labels with a score of ``low`` to ``high``
    per cent of the positive's: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score."""
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    written = write_blocks(spark, integers(rows, vector_id, label, vector, anchor, scale), block_rows)
    if written is None:
        return spark.createDataFrame([], out)
    blocks, zones = written
    batches = anchors_of(spark, blocks)
    whole = batches.select("batch", F.explode("places").alias("place"), F.lit(0).alias("k"), F.lit(-LIMIT).alias("low"), F.lit(LIMIT).alias("high"))
    pairs = materialize(spark, search(blocks, batches, zones, whole, True, positives, seeds)
                        .select("batch", "place", F.col("rank").alias("k"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # low * score <= 100 * x <= high * score without a product that overflows
    tens, rest = F.expr("positive_score div 100"), F.expr("positive_score % 100")
    windows = pairs.select("batch", "place", "k", (tens * low + F.ceil(rest * low / F.lit(100))).alias("low"), (tens * high + F.floor(rest * high / F.lit(100))).alias("high"))
    found = search(blocks, batches, zones, windows.where("low <= high"), False, negatives, seeds).drop("anchor_id")
    return (found.join(pairs, ["batch", "place", "k"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def moved_label(vector_id: str = "vec_id", label: str = "label") -> Column:
    """The label, moved by one where the id is divisible by 7."""
    return F.when(F.col(vector_id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


ship(__name__)
