"""Structured Streaming over the snapshot landing folder.

The polling loop of the original becomes a file stream: new snapshot files
are picked up by ``readStream`` (``maxFilesPerTrigger`` bounds a batch the
way the loader's 30-file batches did) and flattened.

The incremental fact (T2) is a ``foreachBatch`` sink. With the original arrival
grain (no date) a batch is merged into the arrival state of
:mod:`punctual.streaming.arrival_state`. With ``by_service_date`` the unit is
(vehicle, day): positions of the batch's days are re-read from the position
store, the facts of its vehicles on those days are rebuilt and swapped in; the
fact is kept in versions per day, and the batch's days, a literal list, prune the
store's and the fact's partitions. Either way what a batch reads and writes
does not grow with the stream's history, the result equals a full rebuild
after every batch, and replays of an epoch are idempotent.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import PipelineConfig
from ..operators import arrivals as arr
from ..operators import schedule as sch
from ..operators.staging import POSITION_COLS, flatten_positions
from ..functions.timefns import local_ts
from ..session import scratch_path
from ..sinks.materialize import _exists, landed, write_full
from ..sources.snapshots import stream_snapshots
from .arrival_state import fact_table, update_state

def stream_positions(spark: SparkSession, landing: str, max_files: int = 30) -> DataFrame:
    """Streaming staged positions from a folder of snapshot JSON files."""
    return flatten_positions(stream_snapshots(spark, landing, max_files))


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame | None:
    """The streamed fact; None before the first batch. By service date: of every
    day the last version written (the log has one row per batch and day it
    touched); at the original grain: the last version of the log table."""
    if fact_table(spark, fact_path).version().number:
        return fact_table(spark, fact_path).read()
    log = _exists(spark, f"{fact_path}/_log")
    if log is None:
        return None
    last = (log.groupBy("day").agg(F.max_by(F.struct("version", "rows"), "version").alias("v"))
            .select("day", "v.version", "v.rows").collect())  # one row per day
    parts = [f"{fact_path}/v={r.version}/service_date={r.day}" for r in sorted(last) if r.rows]
    if not parts:
        return None
    return spark.read.parquet(*parts)


def update_fact(spark: SparkSession, batch: DataFrame, epoch_id: int, store: str,
                fact_path: str, route_stops: DataFrame, schedule: DataFrame,
                cfg: PipelineConfig) -> None:
    """One micro-batch by service date: store its positions, rebuild the facts it
    can change.

    The rebuild unit is the (vehicle, service date) pair: only the batch's days of
    the store are read and only they are written again. A version holds the days
    it changed; the log that names them is appended last, so a failed batch
    changes nothing and a replay writes the same.
    """
    day = F.coalesce(F.to_date(local_ts("recorded_at", cfg.agency_tz)).cast("string"), F.lit("none"))
    pos = batch.select(*POSITION_COLS).withColumn("service_date", day).withColumn("epoch", F.lit(epoch_id))
    (pos.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("service_date", "epoch").parquet(store))
    # the batch's own part of the store: the sources are read once
    stored = spark.read.schema(pos.schema).parquet(store)
    own = stored.where(F.col("epoch") == epoch_id)
    days = [r[0] for r in own.select("service_date").distinct().collect()]  # days of one batch
    unit = ["vehicle_id", "service_date"]
    touched = own.select(*[F.col(c).alias(f"_{c}") for c in unit]).distinct()
    same = F.lit(True)
    for c in unit:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    history = stored.where(F.col("service_date").isin(days)).join(touched, same, "left_semi")
    cand = arr.proximity_join(history.select(*POSITION_COLS), route_stops, cfg)
    a = arr.actual_arrivals(arr.nearest_stop(cand), True, cfg.agency_tz)
    arrival_day = F.to_date(local_ts("actual_arrival", cfg.agency_tz)).cast("string")
    out = sch.stop_performance(sch.match_schedule(a, schedule, cfg)).withColumn("service_date", arrival_day)
    old = read_fact(spark, fact_path)
    if old is not None:
        old = old.withColumn("service_date", arrival_day).where(F.col("service_date").isin(days))
        out = old.join(touched, same, "left_anti").unionByName(out)
    version = epoch_id + 1
    write_full(out, f"{fact_path}/v={version}", ["service_date"])
    written = spark.read.schema(out.schema).parquet(f"{fact_path}/v={version}")
    rows = {r[0]: r[1] for r in written.groupBy("service_date").count().collect()}
    log = [(version, d, rows.get(d, 0)) for d in sorted(set(days) | set(rows))]
    (spark.createDataFrame(log, "version long, day string, rows long")
     .write.mode("append").parquet(f"{fact_path}/_log"))


def remove_superseded(spark: SparkSession, fact_path: str) -> int:
    """Delete the day folders that a later version replaced; returns how many.
    For use when no reader holds an older listing."""
    log = _exists(spark, f"{fact_path}/_log")
    if log is None:
        return 0
    last = log.groupBy("day").agg(F.max("version").alias("top"))
    old = log.select("version", "day").distinct().join(last, "day").where("version < top").collect()  # batches x days
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{fact_path}/v={r.version}/service_date={r.day}")
        path.getFileSystem(conf).delete(path, True)
    return len(old)


def stream_incremental(spark: SparkSession, positions: DataFrame, route_stops: DataFrame,
                       schedule: DataFrame, store: str, fact_path: str, checkpoint: str,
                       cfg: PipelineConfig | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Start the incremental fact stream; returns the running query. The route
    stops and the timetable are read once, when the stream starts: a new timetable
    takes effect with the next start."""
    cfg = cfg or PipelineConfig()
    route_stops = landed(route_stops, scratch_path(spark, "route_stops"))
    schedule = landed(sch.timetable_points(schedule), scratch_path(spark, "timetable_points"))
    update = update_fact if cfg.by_service_date else partial(update_state, distinct_points=True)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        update(spark, batch, epoch_id, store, fact_path, route_stops, schedule, cfg)

    w = positions.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def load_raw_snapshots(spark: SparkSession, landing: str, raw_path: str, checkpoint: str,
                       batch_files: int = 30) -> StreamingQuery:
    """Load landed snapshot files into the raw table, at most ``batch_files``
    files per append (K2), each file exactly once (the checkpoint records
    which files were loaded), then stop."""
    from ..sources.snapshots import stream_snapshots as _raw
    return (_raw(spark, landing, batch_files).writeStream.format("parquet")
            .option("path", raw_path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
