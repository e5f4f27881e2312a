"""Materialisations (K1-K8).

No table format with MERGE is installed, so upserts are expressed with
anti-joins and written without ever overwriting a path that the same job
reads:

* ``append_incremental``: the fact is partitioned by arrival date. New rows
  (past the high-water mark) only touch the partitions of their own dates,
  so only those partitions are read, merged by key, checkpointed (lineage
  cut from the files about to be replaced) and rewritten with dynamic
  partition overwrite. History partitions are never read or rewritten.
* ``scd2_snapshot``: each run writes a folder of its own and then the next entry
  of a log, if no other run has; readers resolve the last entry, so a failed
  run leaves the previous one and of two runs one starts again.
* :mod:`punctual.sinks.tablelog`: tables whose every change is one atomic commit,
  with upserts that find the files of their keys whatever their date.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_full(df: DataFrame, path: str, partition_by: list[str] | None = None,
               fmt: str = "parquet") -> None:
    """Idempotent full replace (DROP + CREATE TABLE AS)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def _checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` computing ``df`` once
    (cached while the checkpoint files are written, then released)."""
    from ..session import shared_dir
    shared_dir(df.sparkSession)
    df = df.persist()
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out


def landed(df: DataFrame, path: str) -> DataFrame:
    """``df`` computed once into Parquet files at ``path`` and read from there: fewer
    and more compact files than a checkpoint's, of which readers take their columns
    only and whose size the planner knows. Whoever names the path deletes it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``; None only if the path isn't there. With a
    ``schema`` a table without any file is an empty table."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def high_water_mark(spark: SparkSession, path: str, mark: str = "actual_arrival",
                    partition_col: str = "arrival_date"):
    """max(mark) of the target table, or None when it is absent or empty. The
    table is partitioned by the mark's date: only the newest one is read."""
    target = _exists(spark, path, f"{mark} timestamp, {partition_col} date")
    if target is None:
        return None
    newest = target.agg(F.max(partition_col)).first()[0]  # from the partition values
    if newest is None:
        return target.agg(F.max(mark)).first()[0]
    return target.where(F.col(partition_col) == F.lit(newest)).agg(F.max(mark)).first()[0]


def append_incremental(spark: SparkSession, new_rows: DataFrame, path: str,
                       key: str = "trip_stop_id", mark: str = "actual_arrival",
                       partition_col: str = "arrival_date",
                       lookback: dt.timedelta | None = None, since=None) -> int:
    """Append rows newer than the target's high-water mark, replacing rows
    with the same key (delete + insert). Returns the rows taken.

    First run (no table): full build. ``lookback`` re-admits rows up to that
    much older than the mark (late arrivals). An existing but empty target
    admits everything. ``since`` is the mark if the caller has read it. Rows
    without a key never replace others (a NULL key equals none).
    """
    new_rows = new_rows.withColumn(partition_col, F.to_date(F.col(mark)))
    target = _exists(spark, path, new_rows.schema)
    if target is None:
        new_rows.write.mode("overwrite").partitionBy(partition_col).parquet(path)
        return spark.read.schema(new_rows.schema).parquet(path).count()
    hw = since if since is not None else high_water_mark(spark, path, mark, partition_col)
    inc = new_rows
    if hw is not None:
        lim = hw - lookback if lookback else hw
        inc = new_rows.where(F.col(mark) > F.lit(lim))
    # the new rows feed three branches with different projections, which
    # defeats exchange reuse: materialise them once
    inc = _checkpoint(inc)
    n = inc.count()
    if n == 0:
        return 0
    dates = [r[0] for r in inc.select(partition_col).distinct().collect()]  # the new rows' days
    touched = target.where(F.col(partition_col).isin(dates))
    merged = (touched.join(inc.select(key), key, "left_anti")
              .unionByName(inc.select(*touched.columns)))
    # cut lineage: the touched partitions are read here and replaced below
    merged = _checkpoint(merged)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return n


# ------------------------------------------------------------ versioned tables

def runs_of(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed runs, oldest first: the last log entry names them."""
    from .tablelog import _names, _read, entry
    taken = [int(n[:-5]) for n in _names(spark, f"{path}/_log") if n.endswith(".json") and n[0] != "."]
    return json.loads(_read(spark, entry(path, max(taken)))) if taken else []


def commit_run(spark: SparkSession, df: DataFrame, path: str, before: list[str], partition_by: list[str] | None = None, check=None) -> bool:
    """Write ``df`` as a run of its own and commit it after the runs ``before``;
    False if another writer has committed since they were read. ``check`` is given
    the run's folder before that and raises if it must not be committed."""
    from .tablelog import create_if_absent, entry
    run = f"run={uuid.uuid4().hex}"
    write_full(df, f"{path}/{run}", partition_by)
    if check:
        check(f"{path}/{run}")
    return create_if_absent(spark, entry(path, len(before) + 1), json.dumps([*before, run]))


class DuplicateKeyError(RuntimeError):
    pass


def read_scd2(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole history: the open rows of the last run and the rows that each
    run closed."""
    runs = runs_of(spark, path)
    if not runs:
        return None
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/{r}" for r in runs])
    return rows.where((F.col("state") == "closed") | (F.col("run") == runs[-1].removeprefix("run="))).drop("state", "run")


def scd2_snapshot(spark: SparkSession, source: DataFrame, path: str, key: list[str],
                  check_cols: list[str], ts, invalidate_hard_deletes: bool = False, tries: int = 20) -> int:
    """Slowly-changing-dimension (type 2) history with the ``check`` strategy.

    Each source row version carries ``valid_from`` / ``valid_to``; a change in
    any ``check_cols`` closes the open version at ``ts`` and opens a new one.
    Keys missing from the source stay open unless ``invalidate_hard_deletes``.
    A run writes the open rows and the rows it closed (``state=open`` and
    ``state=closed`` below ``run=<id>``) in one pass; rows closed by earlier runs
    are neither read nor written again. A run that another one overtakes is
    computed again from that one's rows. Raises if the key is not unique in the
    source. Returns the number of committed runs.
    """
    ts = F.lit(ts).cast("timestamp")

    def check(run: str) -> None:
        from .tablelog import _delete, _names
        if "state=twice" in _names(spark, run):
            example = spark.read.parquet(f"{run}/state=twice").select(*key).first().asDict()
            _delete(spark, run)
            raise DuplicateKeyError(f"source: the key {key} is not unique, e.g. {example}")

    for _ in range(tries):
        before = runs_of(spark, path)
        hist = spark.read.parquet(f"{path}/{before[-1]}").where("state = 'open'").drop("state") if before else None
        if commit_run(spark, _scd2_rows(source, hist, key, check_cols, ts, invalidate_hard_deletes), path, before, ["state"], check):
            return len(before) + 1
    raise RuntimeError(f"{path}: other writers were first {tries} times")


def _scd2_rows(source: DataFrame, hist: DataFrame | None, key: list[str], check_cols: list[str], ts, invalidate_hard_deletes: bool) -> DataFrame:
    """Open rows and newly closed rows of a run, from the open rows before it. Rows
    whose key the source repeats have the state ``twice``: they are counted where
    they are joined, dealt and sorted by the key once. The key is a struct, in which
    nulls are equal."""
    cols = source.columns
    never = F.lit(None).cast("timestamp")

    def keyed(df: DataFrame, more: list[str]) -> DataFrame:
        return df.select(F.struct(*key).alias("_k"), *[c for c in df.columns if c not in key and c in more])

    def of(side: str, c: str):
        return F.col(f"{side}._k.{c}") if c in key else F.col(f"{side}.{c}")

    s = keyed(source, cols).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_k"))).alias("s")
    if hist is None:
        out = s.select(*[of("s", c).alias(c) for c in cols], ts.alias("valid_from"), never.alias("valid_to"), "_n")
    else:
        h = keyed(hist, [*cols, "valid_from"]).withColumn("_h", F.lit(True)).alias("h")
        j = h.join(s, F.col("h._k") == F.col("s._k"), "full_outer")
        there, here = F.col("h._h").isNotNull(), F.col("s._n").isNotNull()
        same = F.lit(True)
        for c in check_cols:
            same = same & of("h", c).eqNullSafe(of("s", c))
        closes = there & ((here & ~same) | (~here & F.lit(invalidate_hard_deletes)))
        old = F.struct(*[of("h", c).alias(c) for c in cols], F.col("h.valid_from").alias("valid_from"),
                       F.when(closes, ts).otherwise(never).alias("valid_to"), F.col("s._n").alias("_n"))
        new = F.struct(*[of("s", c).alias(c) for c in cols], ts.alias("valid_from"), never.alias("valid_to"), F.col("s._n").alias("_n"))
        both = F.array(F.when(there, old), F.when(here & (~there | ~same), new))
        out = j.select(F.explode(both).alias("r")).where("r IS NOT NULL").select("r.*")
    return out.withColumn("state", F.when(F.col("_n") > 1, "twice").when(F.col("valid_to").isNull(), "open").otherwise("closed")).drop("_n")


def export_stop_coordinates(stops_raw: DataFrame, path: str) -> None:
    """Map layer: stop_id, stop_lat, stop_lon as doubles, non-NULL coordinates."""
    out = (stops_raw.select(F.col("stop_id").cast("string").alias("stop_id"),
                            F.col("stop_lat").try_cast("double").alias("stop_lat"),
                            F.col("stop_lon").try_cast("double").alias("stop_lon"))
           .dropna(subset=["stop_lat", "stop_lon"]))
    write_full(out, path)


def publish_fact(fact: DataFrame, path: str) -> None:
    """Serving copy of the fact, partitioned by route for pruned reads.

    ``rebalance`` clusters rows by route so each route gets few files, while
    AQE splits a route too large for one task across several writers.
    """
    write_full(fact.hint("rebalance", "route_id"), path, partition_by=["route_id"])


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """Append batches whose columns may differ, matching columns by name;
    a column missing from a batch is NULL there (U-1)."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def read_serving_fact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The serving copy with the fact's own schema: ``route_id`` stays a
    string instead of a partition type inferred from folder names."""
    return spark.read.schema(schema).parquet(path)
