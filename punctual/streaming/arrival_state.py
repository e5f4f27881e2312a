"""Mergeable arrival state for the streamed fact at the original grain.

The original arrival grain has no date: an arrival is the first time ever that a
vehicle's trip was nearest to a stop. Instead of rebuilding touched vehicles from
their whole history, three tables carry what history decides:

* ``pings``: the nearest stop of every ping (vehicle, trip, time), in folders of
  hour and epoch. A batch reads the hours it has pings of, for pings told again
  with another place: the nearest over all tellings counts.
* ``arrivals``: a log table of (vehicle, route, trip, stop) with the first
  arrival and the least distance. A batch looks its keys up by the key filters
  of that table, so only files that hold them are read, and merges with ``min``.
* the fact: a log table keyed by (vehicle, stop, arrival time). Only keys whose
  arrival appeared, moved or went are matched to the timetable and replaced.

Old pings of the batch's hours are held against it by hashes first, so only the few
that it tells again, or that share a time with it, are dealt whole. The fact holds
no key but those of arrivals, so while only the stream writes it (each batch notes
the version it left) only keys of arrivals known before are searched for in it.

What a batch reads depends on its own hours and keys, not on the stream's age.
Two rare cases read more, and only then: an arrival that a late ping moves to an
earlier time needs the hour of its old time (other trips of the vehicle may
share it), and a ping told again nearer to another stop takes an arrival's
support away, so the pings of that trip are read from all hours.

Replays: the pings of an epoch overwrite themselves; the fact is committed first
and the arrivals last, both with the epoch as their transaction, so a batch that
failed anywhere is computed again from the same state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators import arrivals as arr
from ..operators import schedule as sch
from ..operators.joins import broadcast_if_small
from ..operators.staging import POSITION_COLS
from ..session import scratch_path
from ..sinks.materialize import landed
from ..sinks.tablelog import LogTable, _delete, _path

ARRIVAL = ["vehicle_id", "route_id", "trip_id", "stop_id", "stop_name"]
FACT_KEY = ["vehicle_id", "stop_id", "actual_arrival"]
BEST = ["distance_m", "stop_id", "route_id", "stop_name"]  # the order of the nearest stop
PING = ("vehicle_id string, trip_id string, recorded_at timestamp, distance_m double, stop_id string, route_id string, "
        "stop_name string, hour string, epoch long")
MERGE_RUNS = 24  # commits of a log table before the small ones are merged


def fact_table(spark: SparkSession, fact_path: str) -> LogTable:
    return LogTable(spark, fact_path, FACT_KEY, ["actual_arrival"])


def arrival_table(spark: SparkSession, store: str) -> LogTable:
    return LogTable(spark, f"{store}/arrivals", ARRIVAL)


def _hour(c: str) -> Column:
    return F.coalesce(F.date_format(F.to_utc_timestamp(F.col(c), F.current_timezone()), "yyyy-MM-dd-HH"), F.lit("none"))


def _same(columns: dict[str, str]) -> Column:
    on = F.lit(True)
    for a, b in columns.items():
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def _among(df: DataFrame, keys: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``columns`` are (not) among those of ``keys``, null-safe."""
    return df.join(keys.select(*[F.col(c).alias(f"_{c}") for c in columns]), _same({c: f"_{c}" for c in columns}), how)


def _pings(spark: SparkSession, store: str, epoch: int, hours: list[str] | None = None) -> DataFrame:
    """Told pings up to an epoch, of some hours (other folders aren't listed) or all."""
    base = f"{store}/pings"
    at = [base] if hours is None else [f"{base}/hour={h}" for h in hours]
    there = [p for p in at if (lambda fs, q: fs.exists(q))(*_path(spark, p)[1:])]
    if not there:
        return spark.createDataFrame([], PING)
    return spark.read.schema(PING).option("basePath", base).parquet(*there).where(F.col("epoch") <= epoch)


def _nearest(pings: DataFrame) -> DataFrame:
    """One row per ping: the nearest stop of all its tellings."""
    best = F.min(F.struct(*BEST)).alias("b")
    return pings.groupBy("vehicle_id", "trip_id", "recorded_at").agg(best).select("vehicle_id", "trip_id", "recorded_at", "b.*")


def _first(nearest: DataFrame) -> DataFrame:
    return arr.actual_arrivals(nearest).select(*ARRIVAL, "actual_arrival", "closest_distance_m")


def _few(df: DataFrame, keys: DataFrame, columns: list[str], land: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Rows of ``df`` whose ``columns`` are among those of ``keys``, null-safe; None
    without any. Hashes of the columns are dealt first, 8 bytes a row; only rows and
    keys whose hashes meet are dealt and compared whole."""
    h = F.xxhash64(*columns)
    met = land(df.select(h.alias("_h")).join(keys.select(h.alias("_h")), "_h", "left_semi").distinct())
    if met.isEmpty():
        return None
    some, known = (x.withColumn("_h", h).join(met, "_h", "left_semi").drop("_h") for x in (df, keys.select(*columns)))
    out = land(_among(some, known, columns))
    return None if out.isEmpty() else out


def update_state(spark: SparkSession, batch: DataFrame, epoch: int, store: str, fact_path: str, route_stops: DataFrame,
                 schedule: DataFrame, cfg: PipelineConfig, app: str = "fact", distinct_points: bool = False) -> None:
    """One micro-batch: merge its pings into the state, replace the facts it changes.
    ``distinct_points``: the timetable's points are known to be distinct. What
    several steps read is computed once, into scratch files that go with the batch."""
    arrivals, facts = arrival_table(spark, store), fact_table(spark, fact_path)
    if arrivals.version().txns.get(app, -1) >= epoch:
        return
    base = arrivals.scratch = facts.scratch = scratch_path(spark, "batch")
    try:
        _merge(spark, batch, epoch, store, arrivals, facts, route_stops, schedule, cfg, app, distinct_points,
               lambda df: landed(df, f"{base}/{uuid.uuid4().hex}"))
    finally:
        _delete(spark, base)
    for table in (facts, arrivals):
        if len(table.version().runs) > MERGE_RUNS:
            table.compact()


def _merge(spark: SparkSession, batch: DataFrame, epoch: int, store: str, arrivals: LogTable, facts: LogTable, route_stops: DataFrame,
           schedule: DataFrame, cfg: PipelineConfig, app: str, distinct_points: bool, land: Callable[[DataFrame], DataFrame]) -> None:
    last, fact = arrivals.version(), facts.version()
    cand = arr.proximity_join(batch.select(*POSITION_COLS), route_stops, cfg)
    own = land(arr.nearest_stop(cand).select("vehicle_id", "trip_id", "recorded_at", *BEST, _hour("recorded_at").alias("hour")))
    hours = [r.hour for r in own.select("hour").distinct().collect()]  # of one batch
    (own.withColumn("epoch", F.lit(epoch).cast("long")).hint("rebalance", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("hour", "epoch").parquet(f"{store}/pings"))

    # the batch's pings with their nearest stop before and after; others at its (vehicle, time)
    ping = ["vehicle_id", "trip_id", "recorded_at"]
    told = _few(_pings(spark, store, epoch - 1, hours), own, ["vehicle_id", "recorded_at"], land)
    mine, others, lost = own, None, None
    if told is not None:
        told = land(_nearest(told))
        others = _among(told, own, ping, "left_anti")
        before = told.select(*[F.col(c).alias(f"_{c}") for c in ping], F.struct(*BEST).alias("before"))
        both = own.join(before, _same({c: f"_{c}" for c in ping}), "left").select(*ping, "before", F.least(F.struct(*BEST), "before").alias("after"))
        mine = land(both.select(*ping, "after.*", "before"))
        other = ~_same({f"before.{c}": c for c in ("route_id", "stop_id", "stop_name")})
        was = [F.col(c) if c in ping else F.col(f"before.{c}").alias(c) for c in ARRIVAL]
        lost = land(mine.where(F.col("before").isNotNull() & other).select(*was).distinct())
        lost = None if lost.isEmpty() else lost

    # the batch's arrivals beside the state's: there now, there before, first times and least distances
    gains = land(_first(mine))
    keys = gains.select(*ARRIVAL)
    old = arrivals.lookup(keys if lost is None else keys.union(lost), last)
    old = None if old is None else land(old)
    old = None if old is None or old.isEmpty() else old

    def beside(now: DataFrame, was: DataFrame | None, how: str, again: bool) -> DataFrame:
        now = now.select(*ARRIVAL, F.struct("actual_arrival", "closest_distance_m").alias("n"))
        if was is None:
            both = now.withColumn("w", F.lit(None).cast(now.schema["n"].dataType))
        else:
            was = was.select(*[F.col(c).alias(f"_{c}") for c in ARRIVAL], F.struct("actual_arrival", "closest_distance_m").alias("w"))
            both = now.join(was, _same({c: f"_{c}" for c in ARRIVAL}), how)
        key = [F.when(F.col("n").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if how == "full_outer" and was is not None else F.col(c) for c in ARRIVAL]
        # an arrival told of before keeps what is less of both, unless its pings are all read again
        less = [F.col(f"n.{c}").alias(c) if again else F.least(f"n.{c}", f"w.{c}").alias(c) for c in ("actual_arrival", "closest_distance_m")]
        return both.select(*key, *less, F.col("w.actual_arrival").alias("was"), F.col("w.closest_distance_m").alias("was_m"),
                           F.col("n").isNotNull().alias("here"), F.col("w").isNotNull().alias("there"), F.lit(again).alias("again"))

    diff = beside(gains, old, "left", False)
    if lost is not None:
        trips = lost.select("vehicle_id", "trip_id").distinct()
        again = _first(_nearest(_among(_pings(spark, store, epoch), trips, ["vehicle_id", "trip_id"])))
        anew = beside(_among(again, lost, ARRIVAL), None if old is None else _among(old, lost, ARRIVAL), "full_outer", True)
        diff = _among(diff, lost, ARRIVAL, "left_anti").unionByName(anew)
    diff = land(diff)
    now = [*ARRIVAL, "actual_arrival", "closest_distance_m"]

    # arrivals that appeared, moved or went, and the facts they change
    moves = ~F.col("here") | ~F.col("there") | ~F.col("actual_arrival").eqNullSafe(F.col("was"))
    moved = diff.where(moves)
    before = moved.where("there").select("vehicle_id", "stop_id", F.col("was").alias("actual_arrival"))
    changed = moved.where("here").select(*FACT_KEY).union(before)

    # all arrivals at the changed (vehicle, stop, time): other trips may share them.
    # The batch's own times have been read; moved arrivals can have others
    peers = [] if others is None else [others.select(*ARRIVAL)]
    late = moved.where("there or again").select("vehicle_id", F.explode(F.array("was", "actual_arrival")).alias("recorded_at"))
    late = land(late.distinct())
    if not late.isEmpty():
        at = [r.hour for r in late.select(_hour("recorded_at").alias("hour")).distinct().collect()]  # hours of moved arrivals
        more = _few(_pings(spark, store, epoch, at), late, ["vehicle_id", "recorded_at"], land)
        peers += [] if more is None else [_nearest(more).select(*ARRIVAL)]
    rest = [] if old is None and lost is None else [diff.where(F.col("here") & ~moves).select(*now)]
    if peers:
        asked = land(reduce(DataFrame.union, peers).distinct())
        unknown = land(_among(asked, _among(diff.select(*ARRIVAL), asked, ARRIVAL), ARRIVAL, "left_anti"))
        more = None if unknown.isEmpty() else arrivals.lookup(unknown, last)
        rest += [] if more is None else [more.select(*now)]
    rest = _few(reduce(DataFrame.union, rest), changed, FACT_KEY, land) if rest else None
    due = moved.where("here").select(*now)
    due = due if rest is None else due.union(rest)
    served = broadcast_if_small(due.select(F.col("route_id").alias("_r"), F.col("stop_id").alias("_s")).distinct(), cfg.scale.broadcast_max_bytes)
    timetable = schedule.join(served, (F.col("route_id") == F.col("_r")) & (F.col("stop_id") == F.col("_s")), "left_semi")
    fresh = sch.stop_performance(sch.match_schedule(due, timetable, cfg, distinct_points))

    # while only this stream has written the fact, it holds no key but those of arrivals before
    held = before if rest is None else before.union(rest.select(*FACT_KEY))
    note, done = f"{app}'s fact", fact.txns.get(app, -1) >= epoch
    alone = fact.number == last.txns.get(note, 0)
    number = facts.upsert(fresh, deletes=changed, txn=(app, epoch), held=(fact.number, held) if alone else None)
    writes = F.col("here") & ~(F.col("there") & F.col("actual_arrival").eqNullSafe(F.col("was")) & F.col("closest_distance_m").eqNullSafe(F.col("was_m")))
    arrivals.upsert(diff.where(writes).select(*now), deletes=diff.where("not here").select(*ARRIVAL), txn=(app, epoch), stable=True,
                    held=(last.number, diff.where(F.col("there") & (writes | ~F.col("here")))), notes={note: number if alone and not done else -1})
