"""MinHash near-duplicate groups: one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges, exact confirmation.

1. ``sign``: a text's set of word shingles (64-bit hashes) falls into BINS bins
   by one hash; the least value of each bin is kept, and an empty bin copies
   the first non-empty bin of its own random order. Bands of these values give
   bucket keys. Texts with equal sets form one class.
2. Each bucket proposes a star: all its classes against one, never all pairs.
   In the centre is the class that meets the most others over all its buckets
   (the original of a group whose copies differ more from each other than from
   it). A pair is confirmed on the full sets:
   100 * |A and B| >= percent * |A or B|.
3. Confirmed links are contracted to components. While a bucket holds two or
   more components, more of its classes become centres: those outside its
   largest component, about 4 of them, then 32, 256 and so on, drawn by hash. Each
   centre is held against all classes of other components in the bucket, taken
   by a star before or not, and then leaves it. This ends when no bucket holds
   two components: every pair of a bucket is confirmed, rejected or within one
   component.
4. Before the full sets are joined, pairs whose sizes or parity sketches rule out
   the similarity are left out: bit k of a sketch is the parity of the number of
   shingles that hash to k, so sketches differ in no more bits than the sets do
   in shingles. Both filters are exact.

With 42 bands of 6 values a pair at the threshold of 0.8 shares no bucket with
probability 3e-6. Classes are told apart by 64-bit hashes of their sets, so n
classes have a wrong merge with probability of about n^2 / 4e19.

Defined results: a null or empty text has no shingle and is linked with
nothing; a text with fewer words than a shingle has its whole sequence as the
one shingle; a null doc_id takes part like any other, and a component of only
null ids has the component_id null. Repeated rows are rows of one class; the
table may be empty; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import LOWER, batches_of_bytes, byte_codes, materialize, mix, sheltered, ship, word_hashes, word_spans

BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
SKETCH = 8  # 64-bit words of a class's parity sketch
FILTER_BITS = 1 << 23  # of the scan's filter of doc ids: 1 MB at any input size


def shingle_sets(buf: np.ndarray, ends: np.ndarray, size: int, codes: np.ndarray):
    """The sorted distinct shingle hashes of each text."""
    low = LOWER[buf]
    s, e, text = word_spans(low, ends)
    h = word_hashes(low, s, e, codes)
    bounds = np.searchsorted(text, np.arange(len(ends) + 1))
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    grams = np.zeros(len(h), np.uint64)
    for k in range(size):
        grams[:len(h) - k] += h[k:] * factors[k]
    grams = mix(grams)
    for i in range(len(ends)):
        a, b = int(bounds[i]), int(bounds[i + 1])
        if b - a >= size:
            g = np.sort(grams[a:b - size + 1])
            yield g[np.concatenate(([True], g[1:] != g[:-1]))]
        elif b > a:
            yield mix(np.array([(h[a:b] * factors[:b - a]).sum() + np.uint64(b - a)], np.uint64))
        else:
            yield grams[:0]


def class_key(g: np.ndarray) -> int:
    """One 64-bit number for a whole set."""
    return int(mix(np.array([mix(g ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(g))], np.uint64)).view(np.int64)[0])


def parity_sketch(g: np.ndarray) -> np.ndarray:
    """SKETCH 64-bit words; each bit is the parity of the hashes that fall on it."""
    counts = np.bincount((mix(g) >> np.uint64(32)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


class Signer:
    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        # for each bin its own random order of all bins (seeded: the same in every task)
        self.order = np.random.default_rng(7).permuted(np.tile(np.arange(self.bins), (self.bins, 1)), axis=1)
        self.factors = mix(np.arange(101, 101 + rows, dtype=np.uint64)) | np.uint64(1)
        self.band = mix(np.arange(1001, 1001 + bands, dtype=np.uint64))

    def minima(self, g: np.ndarray) -> np.ndarray:
        """The densified least value of each bin (g is sorted, so a bin's first)."""
        place = ((g >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        first = np.searchsorted(place, np.arange(self.bins, dtype=np.uint64))
        full = np.diff(np.append(first, len(g))) > 0
        out = g[np.minimum(first, len(g) - 1)]
        empty = np.flatnonzero(~full)
        if len(empty):
            order = self.order[empty]
            out[empty] = out[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
        return out

    def keys(self, g: np.ndarray) -> np.ndarray:
        v = self.minima(g).reshape(self.bands, self.rows)
        return mix((v * self.factors).sum(axis=1) + self.band).view(np.int64)


def sign(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), n (set size), c (class, null for an empty
    set), its bucket keys and its parity sketch."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        codes, signer = byte_codes(11), Signer()
        for batch in batches:
            for at, buf, ends in batches_of_bytes(batch.column(2)):
                n, c, bands, sketch = [], [], [], []
                for g in shingle_sets(buf, ends, size, codes):
                    n.append(len(g))
                    c.append(class_key(g) if len(g) else None)
                    bands.append(signer.keys(g) if len(g) else None)
                    sketch.append(parity_sketch(g) if len(g) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ends)), batch.column(1).slice(at, len(ends)), pa.array(n, pa.int64()),
                     pa.array(c, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
                    ["doc_id", "th", "n", "c", "bands", "sketch"])

    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, th long, n long, c long, bands array<long>, sketch array<long>")


def full_sets(spark: SparkSession, docs: DataFrame, wanted: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """c and h (sorted shingle hashes) of at least the documents whose id is in
    ``wanted``: a bitmap of fixed size keeps most others out of the scan."""
    kind = dict(docs.dtypes)[key]
    bit = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(FILTER_BITS))
    maps = (wanted.select(bit.alias("b")).groupBy(F.expr("bitmap_bucket_number(b)").alias("k"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("bits")).collect())  # at most FILTER_BITS / 32768 + 1 rows of 4 KB
    bits = np.zeros((FILTER_BITS // 32768 + 2, 4096), np.uint8)
    for k, row in maps:
        bits[k] = np.frombuffer(row, np.uint8)

    def run(batches):
        codes = byte_codes(11)
        for batch in batches:
            b, p = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[b, p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1))
            for at, buf, ends in batches_of_bytes(batch.column(3)):
                sets = list(shingle_sets(buf, ends, size, codes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ends)), pa.array([class_key(g) if len(g) else None for g in sets], pa.int64()),
                     pa.array([g.view(np.int64) for g in sets], pa.list_(pa.int64()))], ["doc_id", "c", "h"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("b", bit)
    rows = rows.select("doc_id", F.expr("bitmap_bucket_number(b)").alias("k"), F.expr("bitmap_bit_position(b)").alias("p"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, c long, h array<long>").where("c IS NOT NULL")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame | None:
    """(node, root) of every node of the undirected ``edges`` (u, v): each round
    hooks every node to its least neighbour and contracts; None without edges."""
    mapping = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        hook = materialize(spark, both.groupBy("u").agg(F.min("v").alias("v"))
                           .select(F.col("u").alias("node"), F.least("u", "v").alias("up")), "hook")
        if hook.isEmpty():
            return mapping
        if mapping is None:
            mapping = hook.withColumnRenamed("up", "root")
        else:
            up = hook.select(F.col("node").alias("root"), "up")
            mapping = materialize(spark, mapping.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        a = hook.select(F.col("node").alias("u"), F.col("up").alias("pu"))
        b = hook.select(F.col("node").alias("v"), F.col("up").alias("pv"))
        edges = materialize(spark, edges.join(a, "u").join(b, "v").where("pu <> pv")
                            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "edges")


def merge(spark: SparkSession, roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The components ``roots`` (node, root) after more ``links`` (u, v)."""
    if roots is not None:
        for end in ("u", "v"):
            at = roots.select(F.col("node").alias(end), F.col("root").alias("r"))
            links = links.join(at, end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    more = components(spark, links.where("u <> v").select("u", "v"))
    if more is None or roots is None:
        return roots if more is None else more
    up = more.select(F.col("node").alias("root"), F.col("root").alias("up"))
    old = roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return materialize(spark, old.unionByName(more.join(roots, "node", "left_anti")), "roots")


def with_root(rows: DataFrame, roots: DataFrame | None, column: str, name: str) -> DataFrame:
    """``rows`` with the component of the class in ``column``."""
    if roots is None:
        return rows.withColumn(name, F.col(column))
    at = roots.select(F.col("node").alias(column), F.col("root").alias("__r"))
    return rows.join(at, column, "left").withColumn(name, F.coalesce("__r", column)).drop("__r")


def grouped(spark: SparkSession, docs: DataFrame, size: int, percent: int = 80,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: c (class, null without shingles), doc_id, th,
    n, root (the class that names its component), component_id."""
    signed = materialize(spark, sign(docs, size, key, text), "signed")
    classes = signed.where("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("m"))
    one = (signed.join(classes.withColumnRenamed("c", "cc").hint("shuffle_hash"), (F.col("c") == F.col("cc")) & F.col("doc_id").eqNullSafe(F.col("m")))
           .select("c", "n", "doc_id", "bands"))
    buckets = one.select("c", "n", "doc_id", F.explode("bands").alias("b"))
    shared = buckets.groupBy("b").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
    rest = materialize(spark, buckets.join(shared.select("b", "size"), "b"), "buckets")
    sets = materialize(spark, full_sets(spark, docs, rest.select("doc_id"), size, key, text).select("c", "h"), "sets")
    rest = rest.select("b", "c", "n", "size").distinct()

    # stars: in the centre the class that meets the most others
    met = rest.groupBy("c").agg(F.sum("size").alias("met"))
    stars = rest.join(met, "c").groupBy("b").agg(F.max_by("c", F.struct("met", "c")).alias("c0"))
    rest = rest.join(stars, "b").where("c <> c0")
    first = rest.select(F.least("c", "c0").alias("centre"), F.greatest("c", "c0").alias("c"))
    roots = merge(spark, None, confirm(spark, first, sets, percent))

    # more centres from outside each bucket's largest component, until none holds two
    sketches = signed.where("c IS NOT NULL").groupBy("c").agg(F.first("sketch").alias("sketch"))
    rest, centres = rest.select("b", "c", "n").join(sketches, "c"), 4
    while True:
        rest = with_root(rest, roots, "c", "root")
        most = rest.groupBy("b", "root").agg(F.count("*").alias("k")).groupBy("b").agg(
            F.max(F.struct("k", "root")).alias("s"), F.sum("k").alias("k"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        most = most.where("lo <> hi").select("b", F.col("s.root").alias("most"), (F.col("k") - F.col("s.k")).alias("others"))
        drawn = F.pmod(F.xxhash64("c", "b", F.lit(centres)), F.col("others")) < centres
        rest = materialize(spark, rest.join(most, "b").select("b", "c", "n", "sketch", "root", ((F.col("root") != F.col("most")) & drawn).alias("centre")), "mixed")
        if rest.isEmpty():
            break
        stars = rest.where("centre").select("b", F.col("c").alias("c0"), F.col("root").alias("r0"), F.col("n").alias("n0"), F.col("sketch").alias("sketch0"))
        near = F.least("n", "n0") * 100 >= F.greatest("n", "n0") * percent
        apart = sum((F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("sketch0", F.lit(i)))) for i in range(SKETCH)), F.lit(0))
        close = apart * (100 + percent) <= (F.col("n") + F.col("n0")) * (100 - percent)
        a, b = rest.alias("a"), stars.alias("b")
        pairs = a.join(b, (F.col("a.b") == F.col("b.b")) & (F.col("root") != F.col("r0")) & near & close)
        links = confirm(spark, pairs.select(F.least("c", "c0").alias("centre"), F.greatest("c", "c0").alias("c")), sets, percent)
        roots = merge(spark, roots, links)
        rest = rest.where("NOT centre").select("b", "c", "n", "sketch")
        centres *= 8
    if roots is None:
        whole = classes.select("c", F.col("c").alias("root"), F.col("m").alias("component_id"))
    else:
        owned = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        whole = owned.select("c", "root").join(owned.groupBy("root").agg(F.min("m").alias("component_id")), "root").select("c", "root", "component_id")
    return signed.select("doc_id", "th", "n", "c").join(whole, "c", "left")


def near_duplicates(spark: SparkSession, docs: DataFrame, size: int, percent: int = 80,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, th, n_shingles, component_id (least
    doc_id of its group), kept (doc_id = component_id)."""
    out = grouped(spark, docs, size, percent, key, text)
    component = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def confirm(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (u, v) of ``pairs`` (centre, c) whose full sets are similar enough."""
    member = sets.select("c", F.col("h").alias("hv"))
    centre = sets.select(F.col("c").alias("centre"), F.col("h").alias("hu"))
    both = pairs.distinct().join(member, "c").join(centre, "centre")
    good = (both.withColumn("shared", F.size(F.array_intersect("hu", "hv")))
            .where(F.col("shared") * 100 >= (F.size("hu") + F.size("hv") - F.col("shared")) * percent))
    return materialize(spark, good.select(F.col("centre").alias("u"), F.col("c").alias("v")).distinct(), "links")


@sheltered
def keep_one(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates (the least doc_id,
    null last, then the least text hash; one of rows equal in both); all columns.
    Texts without a shingle are groups of equal id and text."""
    found = grouped(spark, docs, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("s")
    least = found.where("c IS NOT NULL").groupBy("root").agg(first).select("s.doc_id", "s.th")
    found = least.unionByName(found.where("c IS NULL").select("doc_id", "th").distinct()).toDF("__id", "__th")
    found = materialize(spark, found, "kept")
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th"))
    kept = materialize(spark, rows.join(found.hint("shuffle_hash"), on).drop("__hash"), "kept-rows")
    twice = kept.groupBy("__id", "__th").agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    if not twice.isEmpty():
        again = twice.toDF("__i", "__t")
        same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t"))
        kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["__id", "__th"]))
    return kept.select(*docs.columns)


ship(__name__)
