"""Match arrivals to the timetable and build the delay fact (J3, P5, P6, J4, W2,
P8, P9).

The nearest scheduled time is found with a two-sided as-of scan
(:func:`punctual.operators.joins.nearest_asof`) instead of a band join plus
``row_number``: the band join multiplies each arrival by every timetable
entry within 30 minutes (hundreds on a dense timetable), the as-of scan
touches each row once per direction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.rounding import tenths_of_minute
from ..functions.timefns import hms_to_seconds, second_of_day
from .joins import nearest_asof, pick_nearest

DAY_S = 86_400

FACT_COLS = ["trip_stop_id", "vehicle_id", "route_id", "stop_id", "stop_name",
             "actual_arrival", "scheduled_arrival_str", "direction_id",
             "delay_seconds", "delay_minutes"]


def schedule_seconds(stop_times: DataFrame, trips: DataFrame,
                     with_seconds: bool = True) -> DataFrame:
    """Timetable rows with their route, direction and second-of-day.

    Hours >= 24 are kept as-is, so ``sched_secs`` may exceed 86400.
    """
    t = trips.select("trip_id", "route_id", "direction_id")
    st = stop_times.select("trip_id", "stop_id", "stop_sequence", "scheduled_arrival_str")
    return (st.join(t, "trip_id")
            .select("route_id", "stop_id", "scheduled_arrival_str", "direction_id",
                    hms_to_seconds(F.col("scheduled_arrival_str"), with_seconds)
                    .alias("sched_secs"),
                    "trip_id", "stop_sequence"))


def timetable_points(schedule: DataFrame) -> DataFrame:
    """The distinct (route, stop, second, direction, time string) of a timetable,
    which is all that matching reads of it."""
    return schedule.select("route_id", "stop_id", "sched_secs", "direction_id", "scheduled_arrival_str").distinct()


def _schedule_points(schedule: DataFrame, cfg: PipelineConfig, distinct: bool = False) -> DataFrame:
    """Timetable points (route, stop, second, direction, time string); with
    ``wrap_midnight`` also shifted copies one day earlier / later. ``distinct``: the
    timetable's points are distinct already."""
    # rows whose time does not parse keep sched_secs NULL: the as-of scan
    # never pairs them (no NULL-time partition holds arrivals). Filtering them
    # here would be pushed below the joins into the scan and parse every
    # time string before the data is spread.
    s = (schedule.where(F.col("route_id").isNotNull() & F.col("stop_id").isNotNull())
         .select("route_id", "stop_id", "sched_secs", "direction_id", "scheduled_arrival_str"))
    if cfg.wrap_midnight:
        w = cfg.window_s
        later = s.where(F.col("sched_secs") >= DAY_S - w) \
            .withColumn("sched_secs", F.col("sched_secs") - DAY_S)
        earlier = s.where(F.col("sched_secs") < w) \
            .withColumn("sched_secs", F.col("sched_secs") + DAY_S)
        s = s.unionByName(later).unionByName(earlier)
    # a point is met by many trips: distinct points bound every as-of bucket by
    # the seconds of its time span, however large the timetable grows
    return s if distinct and not cfg.wrap_midnight else s.distinct()


def match_schedule(arrivals: DataFrame, schedule: DataFrame,
                   cfg: PipelineConfig | None = None, distinct_points: bool = False) -> DataFrame:
    """Nearest scheduled time per arrival on the same route and stop, within
    ``window_s`` seconds; ties -> earlier time, then lower direction.

    Arrivals sharing (vehicle, stop, arrival time) are then reduced to the
    single best match, as the arrival key of the fact requires.
    """
    cfg = cfg or PipelineConfig()
    a = (arrivals
         .where(F.col("route_id").isNotNull() & F.col("stop_id").isNotNull())
         .select("vehicle_id", "route_id", "trip_id", "stop_id", "stop_name",
                 "actual_arrival",
                 second_of_day(F.col("actual_arrival"), cfg.agency_tz).alias("actual_secs")))
    pts = _schedule_points(schedule, cfg, distinct_points)
    m = nearest_asof(a, pts, keys=["route_id", "stop_id"], left_t="actual_secs",
                     right_t="sched_secs",
                     right_payload=["direction_id", "scheduled_arrival_str"],
                     window=cfg.window_s, skew_rows=cfg.scale.asof_skew_rows,
                     salt_cols=["vehicle_id", "trip_id", "actual_arrival"],
                     bucket_s=cfg.scale.asof_bucket_s,
                     # equal seconds: lowest direction (NULL first), then time string
                     right_tiebreak=[F.col("direction_id"), F.col("scheduled_arrival_str")])
    m = pick_nearest(m, "actual_secs")
    m = m.select("vehicle_id", "route_id", "stop_id", "stop_name", "actual_arrival",
                 "actual_secs", F.col("_m.scheduled_arrival_str").alias("scheduled_arrival_str"),
                 F.col("_m.t").alias("sched_secs"),
                 F.col("_m.direction_id").alias("direction_id"))
    absd = F.abs(F.col("actual_secs") - F.col("sched_secs"))
    best = F.min(F.struct(absd.alias("d"), "sched_secs", "direction_id",
                          "scheduled_arrival_str", "route_id", "stop_name", "actual_secs")
                 ).alias("b")
    return (m.groupBy("vehicle_id", "stop_id", "actual_arrival").agg(best)
            .select("vehicle_id", F.col("b.route_id").alias("route_id"), "stop_id",
                    F.col("b.stop_name").alias("stop_name"), "actual_arrival",
                    F.col("b.actual_secs").alias("actual_secs"),
                    F.col("b.scheduled_arrival_str").alias("scheduled_arrival_str"),
                    F.col("b.sched_secs").alias("sched_secs"),
                    F.col("b.direction_id").alias("direction_id")))


def stop_performance(matched: DataFrame) -> DataFrame:
    """The delay fact: surrogate key, delay in seconds and in minutes (1 dp)."""
    delay = (F.col("actual_secs") - F.col("sched_secs")).cast("long")
    key = F.concat(F.col("vehicle_id"), F.lit("-"), F.col("stop_id"), F.lit("-"),
                   F.col("actual_arrival").cast("string"))
    return (matched
            .withColumn("delay_seconds", delay)
            .withColumn("delay_minutes",
                        tenths_of_minute(F.col("delay_seconds")).cast("double") / F.lit(10.0))
            .withColumn("trip_stop_id", key)
            .select(*FACT_COLS))
