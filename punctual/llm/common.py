"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import functools
import sys
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.session import scratch_path

#: the white space of the word rule, as a regular-expression class
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def ship(module: str) -> None:
    """Send the functions of ``module`` to the tasks by value, so executors
    need no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder (spark.checkpoint.dir)
    and read it back: the lineage ends in files every executor can reach."""
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sheltered(fn):
    """For an operator (spark, docs, ...) that returns rows of ``docs``: columns
    named like its own helpers (``__...``) have other names while it works."""

    @functools.wraps(fn)
    def run(spark, docs, *args, **options):
        told = {x for x in (*args, *options.values()) if isinstance(x, str)}  # columns that the caller names
        other = {c: f"_{uuid.uuid4().hex}" for c in docs.columns if c.startswith("__") and c not in told}
        if not other:
            return fn(spark, docs, *args, **options)
        out = fn(spark, docs.withColumnsRenamed(other), *args, **options)
        return out.withColumnsRenamed({new: c for c, new in other.items()})

    return run


def let(value, body):
    """Bind a column to a lambda variable: ``body`` may use it many times, in
    nested lambdas too, and it is computed once per row."""
    return F.transform(F.array(value), body)[0]


def fold(doc_id: str, buckets: int):
    """crc32 of the id as text, modulo ``buckets`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % buckets


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (fixed public constants of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def byte_codes(seed: int) -> np.ndarray:
    """A random odd 64-bit number for each byte value, from a seed."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(seed)) | np.uint64(1)


def word_spans(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word in concatenated UTF-8 texts.

    ``ends`` are the end offsets of the texts in ``buf``; a word never spans
    two texts. White space is 0x20 and 0x09-0x0D.
    """
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[0] = edge[n] = True
    edge[ends] = True
    s = np.flatnonzero(word & (edge[:n] | np.concatenate(([True], ~word[:-1]))))
    e = np.flatnonzero(word & (edge[1:] | np.concatenate((~word[1:], [True])))) + 1
    return s, e, np.searchsorted(ends, s, side="right")


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each word buf[s:e]: codes[byte] * base^place, summed and mixed."""
    if len(s) == 0:
        return np.zeros(0, np.uint64)
    lens = e - s
    total = int(lens.sum())
    place = np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(lens) - lens, lens)
    powers = np.ones(int(lens.max()), np.uint64)
    with np.errstate(over="ignore"):
        if len(powers) > 1:
            powers[1:] = _BASE
            powers = np.cumprod(powers, dtype=np.uint64)
        at = np.repeat(s, lens) + place
        sums = np.add.reduceat(codes[buf[at]] * powers[place], np.cumsum(lens) - lens)
        return mix(sums + lens.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def batches_of_bytes(column, limit: int = 2_000_000):
    """Split an Arrow string column into runs of whole texts of about ``limit``
    bytes: (first row, byte buffer, end offset of each text). Null is empty. The
    buffers are views of the column, not copies."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, data[offsets[at]:offsets[end]], offsets[at + 1:end + 1] - offsets[at]
        at = end


def chunks(column, chars: int = 2_000_000):
    """(first row, rows) of runs of whole texts with about ``chars`` characters."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > chars:
            yield at, i - at
            at, total = i, 0
        total += n
    if len(sizes) > at:
        yield at, len(sizes) - at


ship(__name__)
