"""Slowly-changing dimensions with change capture by row hashes (K5).

The history is a log table of two kinds of files: open row versions and closed
ones, both dealt into buckets by key. An open row carries two 64-bit hashes
of its checked columns. A run compares the source with the open rows in two steps:

1. Both sides are reduced, before any shuffle, to one digest for each of at most
   2**20 ranges of the key's hash (exclusive-or of row hashes, and a count).
2. Only rows of the ranges whose digests differ are joined by key, once, with the
   file of each open row; the pairs go to scratch files, from which the rows to open,
   those to close and their files are taken.

Only files that hold a key to close are read again and written anew; closed
rows go to files of their own and are never read by a run. Both are one commit,
so readers see a run wholly or not at all, and a run that another one overtakes
is computed again from that one's rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .materialize import DuplicateKeyError, _checkpoint
from .tablelog import LogTable, Version, without

MOST_RANGES = 20  # bits: a million digests of four longs are what is broadcast at most
ROWS_A_RANGE = 64


def _flat(cols: list[str]) -> list:
    """Columns and whether they are null: a hash skips nulls."""
    return [x for c in cols for x in (F.col(c), F.col(c).isNull())]


class HistoryTable:
    """Type 2 history at ``path``: source columns, ``valid_from``, ``valid_to``
    (null while open). A change of any of ``check_cols`` closes a row version."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], check_cols: list[str], rows_per_file: int = 1_000_000):
        self.key, self.check_cols = key, check_cols
        self.table = LogTable(spark, path, key, rows_per_file=rows_per_file)

    # -------------------------------------------------------- reading

    def read(self, number: int | None = None) -> DataFrame | None:
        """The whole history as of a version; None before the first run."""
        df = self.table.read(number)
        return None if df is None else df.drop("_h1", "_h2")

    def read_open(self) -> DataFrame | None:
        v = self._only(self.table.version(), "open")
        return None if v.schema is None else self._load(v).drop("_h1", "_h2")

    @staticmethod
    def _only(v: Version, state: str) -> Version:
        return Version(v.number, v.schema, tuple(r for r in v.runs if r["state"] == state), v.txns)

    def _load(self, v: Version) -> DataFrame:
        found = self.table.files(v)
        return self.table._load([] if found is None else sorted(r.file for r in found.select("file").collect()), v.schema)

    # -------------------------------------------------------- change capture

    def _keyed(self, df: DataFrame, bits: int) -> DataFrame:
        h = F.xxhash64(*_flat(self.key))
        return df.withColumn("_range", F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long"))

    def _differing(self, source: DataFrame, held: DataFrame) -> DataFrame:
        """Ranges of the key's hash in which the two sides aren't equal."""
        row = [F.xxhash64(F.col("_h1"), *_flat(self.key)), F.xxhash64(F.col("_h2"), F.lit(7), *_flat(self.key))]
        digest = F.struct(F.bit_xor(row[0]).alias("x"), F.bit_xor(row[1]).alias("y"), F.count(F.lit(1)).alias("n"))
        a = source.groupBy("_range").agg(digest.alias("a"))
        b = held.groupBy("_range").agg(digest.alias("b"))
        return a.join(b, "_range", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("_range")

    def _pairs(self, source: DataFrame, held: DataFrame) -> DataFrame:
        """Source rows beside the open rows of their keys, both whole, in scratch files:
        ``_k`` (the key as a struct, in which nulls are equal), ``_s``, ``_h``, and ``_twice``
        where the source repeats the key. Both sides are dealt by the key once, which
        counts it, too; hashes are computed anew, not sent."""

        def side(df: DataFrame, name: str) -> DataFrame:
            rest = [F.col(c) for c in df.columns if c not in (*self.key, "_h1", "_h2")]
            return df.select(F.struct(*self.key).alias("_k"), F.struct(F.lit(True).alias("_"), *rest).alias(name))

        s = side(source, "_s").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_k")))
        j = side(held, "_h").join(s, "_k", "full_outer").select("_k", "_s", "_h", (F.col("_n") > 1).alias("_twice"))
        path = scratch_path(self.table.spark, "history-pairs")
        j.write.parquet(path)
        return self.table.spark.read.schema(j.schema).parquet(path)

    def capture(self, source: DataFrame, ts, invalidate_hard_deletes: bool = False, txn: tuple[str, int] | None = None, tries: int = 20) -> int:
        """One run: new and changed rows of ``source`` open at ``ts``, the changed
        ones' open versions close at ``ts``; keys missing from the source stay
        open unless ``invalidate_hard_deletes``. ``source`` is read up to twice
        and must give the same rows each time. A run without changes commits
        nothing. Raises if the source repeats a key. Returns the version that
        holds the run."""
        ts, never = F.lit(ts).cast("timestamp"), F.lit(None).cast("timestamp")
        hashes = {f"_h{i}": F.xxhash64(F.lit(i), *_flat(self.check_cols)) for i in (1, 2)}
        fresh = source.select("*", ts.alias("valid_from"), never.alias("valid_to"), *[h.alias(n) for n, h in hashes.items()])
        table = self.table

        def plan(v: Version) -> Version | None:
            if txn and v.txns.get(txn[0], -1) >= txn[1]:
                return None
            schema = v.schema or fresh.schema.json()
            names = T.StructType.fromJson(json.loads(schema)).names
            now = Version(v.number, schema, self._only(v, "open").runs, v.txns)
            held = sum(r["rows"] for r in now.runs)
            bits = min(MOST_RANGES, max(0, math.ceil(math.log2(max(1, held) / ROWS_A_RANGE))))
            file = F.substring_index("_metadata.file_path", "/", -4) if held else F.lit(None).cast("string")
            s, h = self._keyed(fresh, bits), self._keyed(self._load(now).select("*", file.alias("_file")), bits)
            if held:
                other = F.broadcast(_checkpoint(self._differing(s, h)))  # at most 2**MOST_RANGES longs
                s, h = s.join(other, "_range", "left_semi"), h.join(other, "_range", "left_semi")
            pairs = self._pairs(s.drop("_range", "valid_from", "valid_to"), h.drop("_range"))
            twice = pairs.where("_twice").select("_k.*").first()
            if twice:
                raise DuplicateKeyError(f"source: the key {self.key} is not unique, e.g. {twice.asDict()}")

            def hash_of(side: str, i: int) -> Column:
                cols = [F.col(f"_k.{c}") if c in self.key else F.col(f"{side}.{c}") for c in self.check_cols]
                return F.xxhash64(F.lit(i), *[x for c in cols for x in (c, c.isNull())])

            here, there = F.col("_s").isNotNull(), F.col("_h").isNotNull()
            same = here & there & (hash_of("_s", 1) == hash_of("_h", 1)) & (hash_of("_s", 2) == hash_of("_h", 2))
            pairs = pairs.select("*", (here & ~same).alias("opens"), (there & ~same & (here | F.lit(invalidate_hard_deletes))).alias("closes"))

            def whole(df: DataFrame, side: str, **values: Column) -> DataFrame:
                """Rows of the history from one side of the pairs."""
                own = {c: F.col(f"_k.{c}") if c in self.key else F.col(f"{side}.{c}") for c in names if c not in (*values, *hashes)}
                return df.select(*[(values | own)[c].alias(c) for c in names if c not in hashes]).select("*", *[h.alias(n) for n, h in hashes.items()]).select(*names)

            n_opens, n_closes = pairs.agg(F.count_if("opens"), F.count_if("closes")).first()
            told = v.txns | ({txn[0]: txn[1]} if txn else {})
            if not n_opens and not n_closes:
                # the first run commits its columns, even without rows
                return None if v.schema and not txn else Version(v.number + 1, schema, v.runs, told)
            closing = pairs.where("closes")
            hit = sorted(r.f for r in closing.select(F.col("_h._file").alias("f")).distinct().collect())
            new = whole(pairs.where("opens"), "_s", valid_from=ts, valid_to=never)
            n_old = 0
            if hit:  # the other rows of the files with a closed row: of differing ranges and of equal ones
                n_old = table.files(now).where(F.col("file").isin(hit)).agg(F.sum("rows")).first()[0]
                equal = self._keyed(table._load(hit, schema), bits).join(other, "_range", "left_anti").select(*names)
                new = new.unionByName(whole(pairs.where(there & ~F.col("closes") & F.col("_h._file").isin(hit)), "_h")).unionByName(equal)
            runs = {"open": table._write(new, n_old - n_closes + n_opens),
                    "closed": table._write(whole(closing, "_h", valid_to=ts), n_closes)}
            closed = self._only(v, "closed").runs
            return Version(v.number + 1, schema, without(now.runs, hit) + closed + tuple(r | {"state": k} for k, r in runs.items() if r), told)

        return table._commit(plan, tries)

    def compact(self, tries: int = 20) -> int:
        """Merge the small commits of open rows, and those of closed rows."""
        table = self.table

        def plan(v: Version) -> Version | None:
            runs = v.runs
            for state in ("open", "closed"):
                some = tuple(r for r in runs if r["state"] == state and (r["rows"] < table.rows_per_file or r["without"]))
                if len(some) > 1:
                    run = table._write(self._load(Version(v.number, v.schema, some, v.txns)), sum(r["rows"] for r in some))
                    runs = tuple(r for r in runs if r not in some) + ((run | {"state": state},) if run else ())
            return None if runs == v.runs else Version(v.number + 1, v.schema, runs, v.txns)

        return table._commit(plan, tries)
