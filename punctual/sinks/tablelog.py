"""Tables with atomic commits and key-located upserts (K1, K3).

A table is a folder of immutable Parquet data files and a log. Log entry n names
the files of version n; it is written whole under a name of its own and then
put in place only if no entry n exists, so of two writers one commits version
n and the other finds it taken, reads it and tries version n + 1. Readers resolve
the last entry: they never see part of a commit, and a writer that dies before
its entry leaves only files that no entry names (``remove_orphans``).

Every commit deals its rows by a hash of the key into 2**p buckets of at most
about ``rows_per_file`` rows, one file each, and writes a manifest beside them:
a blocked Bloom filter of each file's keys (segments of 512 words of 64 bits, one
for about 1000 keys, five bits of one word a key) with the number of rows and the
least and greatest values of the ``stats`` columns. An upsert joins hashes of its keys
with the segments of their own buckets, an equi-join whose rows are keys x commits at
most, and gets the files that can hold them and the hashes that let them pass; only
rows and keys of these hashes are compared whole, which drops false alarms. Only files that hold a key of the batch are read in full and
written anew, whatever their date, so the key need not contain a partition
column. ``compact`` merges small commits, which bounds the commits a key is held
against.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .materialize import landed

SEGMENT_WORDS = 512
BITS_PER_KEY = 32
FILTER = "file string, p int, s int, hp long, seg long, words array<int>, bits array<bigint>"


class CommitConflict(RuntimeError):
    pass


# ------------------------------------------------------------ files of the log

def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, fs.makeQualified(p)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to ``path`` in one step unless the path exists; whether it
    did. The text is written under another name first; a hard link (local and
    mounted file systems) or a rename that never replaces (others) puts it in
    place."""
    jvm, fs, target = _path(spark, path)
    temp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if target.toUri().getScheme() == "file":
            at = jvm.java.nio.file.Paths.get
            jvm.java.nio.file.Files.createLink(at(target.toUri()), at(temp.toUri()))
        else:
            hadoop = jvm.org.apache.hadoop.fs
            never_replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            hadoop.FileContext.getFileContext(target.toUri(), conf).rename(temp, target, never_replace)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(temp, False)


def _names(spark: SparkSession, path: str) -> list[str]:
    _, fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> str:
    _, fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    _, fs, p = _path(spark, path)
    fs.delete(p, True)


# ------------------------------------------------------------ versions

@dataclass(frozen=True)
class Version:
    """One log entry. ``runs``: the commits that still have files (run, p, s,
    rows, files, without: removed files); ``txns``: last batch of each application."""

    number: int = 0
    schema: str | None = None
    runs: tuple[dict, ...] = ()
    txns: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema, "runs": list(self.runs), "txns": self.txns})


def entry(path: str, number: int) -> str:
    return f"{path}/_log/{number:020d}.json"


class LogTable:
    """A table at ``path`` whose rows are located by ``key`` (null-safe; the
    table itself doesn't force it to be unique)."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], stats: list[str] | None = None,
                 rows_per_file: int = 1_000_000):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.stats, self.rows_per_file = stats or [], rows_per_file
        self.scratch: str | None = None  # a folder of the caller's for files of one call

    def _scratch(self) -> str:
        return f"{self.scratch}/{uuid.uuid4().hex}" if self.scratch else scratch_path(self.spark, "log-scratch")

    # -------------------------------------------------------- reading

    def version(self, number: int | None = None) -> Version:
        """The last committed version, or an older one."""
        if number is None:
            taken = [int(n[:-5]) for n in _names(self.spark, f"{self.path}/_log") if n.endswith(".json") and n[0] != "."]
            if not taken:
                return Version()
            number = max(taken)
        e = json.loads(_read(self.spark, entry(self.path, number)))
        return Version(number, e["schema"], tuple(e["runs"]), e["txns"])

    def files(self, v: Version) -> DataFrame | None:
        """file, rows, lo and hi of the stats columns, of all files of a version."""
        if not v.runs:
            return None
        found = self._present(self.spark.read.parquet(*[f"{self.path}/manifest/{r['run']}" for r in v.runs]), v)
        spans = [F.struct(F.lit(0).alias("_"), *[f(f"{n}.{c}").alias(c) for c in self.stats]).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"))]
        return found.groupBy("file").agg(F.sum("rows").alias("rows"), *spans)

    def _present(self, df: DataFrame, v: Version) -> DataFrame:
        gone = [f for r in v.runs for f in r["without"]]
        return df.join(self.spark.createDataFrame([(f,) for f in gone], "file string"), "file", "left_anti") if gone else df

    def _load(self, files: list[str], schema: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        if not files:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*[f"{self.path}/{f}" for f in files])

    def read(self, number: int | None = None, between: dict | None = None) -> DataFrame | None:
        """Rows of a version (the last by default); None before the first commit.
        ``between`` = {stats column: (least, greatest)} reads only files that
        can hold such rows."""
        v = self.version(number)
        if v.schema is None:
            return None
        found = self.files(v)
        for c, (least, greatest) in (between or {}).items():
            if found is not None:
                found = found.where((F.col(f"hi.{c}") >= F.lit(least)) & (F.col(f"lo.{c}") <= F.lit(greatest)))
        df = self._load([] if found is None else sorted(r.file for r in found.select("file").collect()), v.schema)
        for c, (least, greatest) in (between or {}).items():
            df = df.where(F.col(c).between(F.lit(least), F.lit(greatest)))
        return df

    def greatest(self, column: str):
        """Greatest value of a stats column, from the manifests alone (upper
        bounds of the files are values of their rows)."""
        found = self.files(self.version())
        return None if found is None else found.agg(F.max(f"hi.{column}")).first()[0]

    # -------------------------------------------------------- keys

    def _places(self, p: int, s: int, h: Column | None = None) -> tuple[Column, Column]:
        """Bucket of a key (or its hash) among 2**p and bitmap of its file among 2**s."""
        h = F.xxhash64(*self.key) if h is None else h
        hp = F.shiftrightunsigned(h, 64 - p) if p else F.lit(0).cast("long")
        seg = F.shiftrightunsigned(F.shiftleft(h, p), 64 - s) if s else F.lit(0).cast("long")
        return hp, seg

    def _word(self, g: Column | None = None) -> tuple[Column, Column]:
        """The word of a key (or its second hash) in its segment and its five bits there."""
        g = F.xxhash64(F.lit(1), *self.key) if g is None else g
        mask = F.lit(0).cast("long")
        for i in range(5):
            place = F.shiftrightunsigned(g, 9 + 6 * i).bitwiseAND(63).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return g.bitwiseAND(SEGMENT_WORDS - 1).cast("int"), mask

    def same_key(self, prefix: str) -> Column:
        on = F.lit(True)
        for c in self.key:
            on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
        return on

    def _hashes(self) -> list[Column]:
        """Two hashes of a key, which give its bucket, segment, word and bits."""
        return [F.xxhash64(*self.key).alias("_h"), F.xxhash64(F.lit(1), *self.key).alias("_g")]

    def _suspects(self, keys: DataFrame, v: Version, path: str) -> tuple[list[str], DataFrame | None]:
        """Files whose filters don't rule out a key of ``keys``, and the hashes of such
        keys, kept at ``path``: of absent ones a chance of about 3e-4 each. Only hashes
        meet the filters."""
        if not v.runs:
            return [], None
        h, g = F.col("_h"), F.col("_g")
        shapes = [F.struct(F.lit(p).alias("p"), F.lit(s).alias("s"), *[c.alias(n) for c, n in zip(self._places(p, s, h), ("hp", "seg"))])
                  for p, s in sorted({(r["p"], r["s"]) for r in v.runs})]
        word, mask = self._word(g)
        asked = keys.select(*self._hashes()).select(F.explode(F.array(*shapes)).alias("at"), "_h", "_g", word.alias("word"), mask.alias("mask")).select("at.*", "_h", "_g", "word", "mask")
        filters = self.spark.read.schema(FILTER).parquet(*[f"{self.path}/manifest/{r['run']}" for r in v.runs])
        at = F.array_position("words", F.col("word")).cast("int")
        there = F.when(at > 0, F.get("bits", at - 1).bitwiseAND(F.col("mask")) == F.col("mask"))
        hit = landed(asked.join(filters, ["p", "s", "hp", "seg"]).where(there).select("file", "_h", "_g"), path)
        files = sorted(r.file for r in self._present(hit.select("file").distinct(), v).collect())
        return files, hit.select("_h", "_g").distinct()

    def _held(self, keys: DataFrame, suspects: DataFrame, rows: DataFrame) -> DataFrame:
        """Rows whose key is among ``keys``. Rows and keys are reduced to those with a
        suspect's hashes first, few unless most keys are there, then compared whole."""
        def few(df: DataFrame, columns: list) -> DataFrame:
            return df.select(*columns, *self._hashes()).join(suspects, ["_h", "_g"], "left_semi").drop("_h", "_g")

        known = few(keys, [F.col(c) for c in self.key]).select(*[F.col(c).alias(f"_{c}") for c in self.key])
        return few(rows, [F.col(c) for c in rows.columns]).join(known, self.same_key("_"), "left_semi")

    def locate(self, keys: DataFrame, v: Version) -> list[str]:
        """Files of a version that hold a key of ``keys`` (columns of the key)."""
        path = self._scratch()
        try:
            maybe, suspects = self._suspects(keys, v, path)
            if not maybe:
                return []
            rows = self._load(maybe, v.schema).select(*self.key, F.col("_metadata.file_path").alias("_f"))
            real = self._held(keys, suspects, rows).select(F.substring_index("_f", "/", -4).alias("f")).distinct()
            return sorted(r.f for r in real.collect())
        finally:
            _delete(self.spark, path)

    def lookup(self, keys: DataFrame, v: Version | None = None) -> DataFrame | None:
        """The rows of a version whose key is among ``keys``, from the files whose
        filters don't rule them out; None before the first commit."""
        v = v or self.version()
        if v.schema is None:
            return None
        maybe, suspects = self._suspects(keys, v, self._scratch())
        return self._held(keys, suspects, self._load(maybe, v.schema)) if maybe else self._load([], v.schema)

    # -------------------------------------------------------- writing

    def _write(self, rows: DataFrame, most: int) -> dict | None:
        """Data files and manifest of one commit of at most ``most`` rows; None
        without rows."""
        if not most:
            return None
        run = uuid.uuid4().hex
        p = max(0, math.ceil(math.log2(most / self.rows_per_file)))
        s = max(0, math.ceil(math.log2(most / 2 ** p * BITS_PER_KEY / (64 * SEGMENT_WORDS))))
        hp, seg = self._places(p, s)
        # a task a bucket: a hash of the bucket would leave tasks empty and give others two
        (rows.withColumn("_hp", hp).repartitionById(2 ** p, F.col("_hp").cast("int")).sortWithinPartitions("_hp")
         .write.partitionBy("_hp").parquet(f"{self.path}/data/{run}"))
        schema = T.StructType([*rows.schema.fields, T.StructField("_hp", T.LongType())])
        written = self.spark.read.schema(schema).parquet(f"{self.path}/data/{run}")
        name = F.concat(F.lit(f"data/{run}/"), F.substring_index("_metadata.file_path", "/", -2)).alias("file")
        word, mask = self._word()
        place = ["file", "hp", "seg"]

        def extremes(of: dict) -> list[Column]:
            return [F.struct(F.lit(0).alias("_"), *[f(of.get(n, "") + c).alias(c) for c in self.stats]).alias(n) for n, f in (("lo", F.min), ("hi", F.max))]

        (written.select(name, F.col("_hp").alias("hp"), seg.alias("seg"), word.alias("word"), mask.alias("mask"), *self.stats)
         .repartition("hp", "seg").groupBy(*place, "word").agg(F.bit_or("mask").alias("mask"), F.count(F.lit(1)).alias("n"), *extremes({}))
         .groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("w"), F.sum("n").alias("rows"), *extremes({"lo": "lo.", "hi": "hi."}))
         .select("file", F.lit(p).alias("p"), F.lit(s).alias("s"), "hp", "seg", F.col("w.word").alias("words"), F.col("w.mask").alias("bits"), "rows", "lo", "hi")
         .write.parquet(f"{self.path}/manifest/{run}"))
        count, files = self.spark.read.parquet(f"{self.path}/manifest/{run}").agg(F.sum("rows"), F.count_distinct("file")).first()
        return {"run": run, "p": p, "s": s, "rows": count, "files": files, "without": []} if count else None

    def _commit(self, plan: Callable[[Version], Version | None], tries: int) -> int:
        """Commit what ``plan`` makes of the last version; anew from the next one
        when another writer was first. ``plan`` returns None if nothing is to do."""
        for attempt in range(tries):
            last = self.version()
            new = plan(last)
            if new is None:
                return last.number
            if create_if_absent(self.spark, entry(self.path, last.number + 1), new.text()):
                return last.number + 1
            time.sleep(min(0.05 * attempt, 1.0))
        raise CommitConflict(f"{self.path}: other writers were first {tries} times")

    @staticmethod
    def _told(v: Version, txn: tuple[str, int] | None) -> dict:
        return v.txns | ({txn[0]: txn[1]} if txn else {})

    def replace(self, rows: DataFrame, txn: tuple[str, int] | None = None, tries: int = 20) -> int:
        """The whole table anew in one commit; readers see the old one until then."""
        from .materialize import _checkpoint
        rows = _checkpoint(rows)
        run = self._write(rows, rows.count())

        def plan(v: Version) -> Version | None:
            if txn and v.txns.get(txn[0], -1) >= txn[1]:
                return None
            return Version(v.number + 1, rows.schema.json(), (run,) if run else (), self._told(v, txn))

        return self._commit(plan, tries)

    def upsert(self, rows: DataFrame, deletes: DataFrame | None = None, txn: tuple[str, int] | None = None, tries: int = 20,
               stable: bool = False, held: tuple[int, DataFrame] | None = None, notes: dict | None = None) -> int:
        """Replace all rows whose key is in ``rows`` or ``deletes`` by ``rows``.

        ``txn`` (application, batch number) makes a replayed batch change
        nothing. The batch is computed once (``stable``: ``rows`` are read from files
        and needn't be); if another writer commits first, only the files to rewrite
        are looked up again, and written again if they are others. ``held`` (version,
        keys) tells which keys of the batch that version holds at most: only they are
        looked up if it is still the last. ``notes`` are kept beside the last batches.
        Returns the version that holds the batch.
        """
        base, kept = self._scratch(), None
        if not stable:
            rows = landed(rows, f"{base}/rows")
        count, found, run = rows.count(), None, None

        def keys() -> DataFrame:
            nonlocal kept
            if kept is None:
                kept = rows.select(*self.key)
                if deletes is not None:
                    kept = landed(kept.union(deletes.select(*self.key)).distinct(), f"{base}/keys")
            return kept

        def plan(v: Version) -> Version | None:
            nonlocal found, run
            if txn and v.txns.get(txn[0], -1) >= txn[1]:
                return None
            told = held is not None and held[0] == v.number
            some = held[1].select(*self.key) if told else keys()
            hit = [] if told and some.isEmpty() else self.locate(some, v)
            if hit != found:
                out, most = rows, count
                if hit:
                    known = some.select(*[F.col(c).alias(f"_{c}") for c in self.key])
                    out = self._load(hit, v.schema).join(known, self.same_key("_"), "left_anti").unionByName(rows)
                    most += self.files(v).where(F.col("file").isin(hit)).agg(F.sum("rows")).first()[0]
                found, run = hit, self._write(out, most)
            return Version(v.number + 1, v.schema or rows.schema.json(), without(v.runs, hit) + ((run,) if run else ()), self._told(v, txn) | (notes or {}))

        try:
            return self._commit(plan, tries)
        finally:
            _delete(self.spark, base)

    def compact(self, small: int | None = None, tries: int = 20) -> int:
        """Merge the commits with fewer than ``small`` rows (``rows_per_file`` by
        default) and the rest of those with removed files into one."""
        def plan(v: Version) -> Version | None:
            some = [r for r in v.runs if r["rows"] < (small or self.rows_per_file) or r["without"]]
            if len(some) < 2:
                return None
            found = self.files(Version(v.number, v.schema, tuple(some), v.txns))
            names = sorted(r.file for r in found.select("file").collect())
            run = self._write(self._load(names, v.schema), sum(r["rows"] for r in some))
            return Version(v.number + 1, v.schema, tuple(r for r in v.runs if r not in some) + ((run,) if run else ()), v.txns)

        return self._commit(plan, tries)

    def remove_orphans(self, older_than_s: float = 86_400.0, keep_versions: int = 10) -> int:
        """Delete the runs that none of the last ``keep_versions`` versions names
        and that are older than any running writer; returns how many."""
        last = self.version().number
        named = {r["run"] for n in range(max(1, last - keep_versions + 1), last + 1) for r in self.version(n).runs}
        _, fs, data = _path(self.spark, f"{self.path}/data")
        if not fs.exists(data):
            return 0
        now, gone = time.time() * 1000, 0
        for status in fs.listStatus(data):
            run = status.getPath().getName()
            if run not in named and now - status.getModificationTime() >= older_than_s * 1000:
                _delete(self.spark, f"{self.path}/manifest/{run}")
                _delete(self.spark, f"{self.path}/data/{run}")
                gone += 1
        return gone


def without(runs: tuple[dict, ...], files: list[str]) -> tuple[dict, ...]:
    """The runs less some of their files; runs with none left go."""
    of: dict[str, list[str]] = {}
    for f in files:
        of.setdefault(f.split("/")[1], []).append(f)
    left = (r | {"without": sorted({*r["without"], *of.get(r["run"], [])})} for r in runs)
    return tuple(r for r in left if len(r["without"]) < r["files"])
