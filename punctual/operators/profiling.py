"""Diagnostic queries over raw, staged and modelled tables (A18-A24, J6, J7,
O-5, F5-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import int_div
from ..functions.timefns import epoch_to_ts, hms_to_seconds, local_ts, second_of_day
from .joins import nearest_asof, pick_nearest


def freshness(layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and time range per layer: {name: (df, timestamp column)}."""
    out = None
    for name, (df, ts) in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("earliest"),
                     F.max(ts).alias("latest")).select(F.lit(name).alias("layer"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def activity_by_hour(df: DataFrame, ts: str = "recorded_at",
                     id_col: str | None = "vehicle_id") -> DataFrame:
    """Readings per hour of day, with distinct vehicles when ``id_col`` is set."""
    aggs = [F.count(F.lit(1)).alias("readings")]
    if id_col:
        aggs.append(F.count_distinct(id_col).alias("buses"))
    return df.groupBy(F.hour(ts).alias("hour")).agg(*aggs).orderBy("hour")


def arrivals_by_hour(arrivals: DataFrame, ts: str = "actual_arrival") -> DataFrame:
    """Arrivals per hour of day, in hour order."""
    return arrivals.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("arrivals")).orderBy("hour")


def raw_counts(raw: DataFrame) -> DataFrame:
    """Rows, distinct polls and distinct snapshot files of the raw landing table
    (a poll may be written as several files)."""
    return raw.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("snapshot_ts").alias("polls"),
                   F.count_distinct("filename").alias("snapshot_files"))


def route_stop_count(stop_times: DataFrame, trips: DataFrame, route: str) -> DataFrame:
    t = trips.where(F.col("route_id") == route).select("trip_id")
    return (stop_times.select("trip_id", "stop_id").join(t, "trip_id")
            .agg(F.count_distinct("stop_id").alias("stops_in_schedule")))


def route_trip_count(trips: DataFrame, route: str) -> DataFrame:
    return trips.where(F.col("route_id") == route).agg(F.count(F.lit(1)).alias("n_trips"))


def top_routes(raw_positions: DataFrame, prefix: str, k: int = 10) -> DataFrame:
    """Readings per route for routes starting with ``prefix`` (top-k report)."""
    return (raw_positions.where(F.col("route_id").startswith(prefix))
            .groupBy(F.col("route_id").alias("route")).agg(F.count(F.lit(1)).alias("readings"))
            .orderBy(F.col("readings").desc(), F.col("route").asc()).limit(k))


def route_schedule(stop_times: DataFrame, trips: DataFrame, stops: DataFrame, route: str,
                   n: int = 8) -> DataFrame:
    """First ``n`` timetable rows of a route by (trip, stop sequence)."""
    t = trips.where(F.col("route_id") == route).select("trip_id")
    j = (stop_times.select("trip_id", "stop_id", "stop_sequence", "scheduled_arrival_str")
         .join(t, "trip_id").join(stops.select("stop_id", "stop_name"), "stop_id"))
    return (j.orderBy("trip_id", "stop_sequence", "stop_id", "scheduled_arrival_str").limit(n)
            .select("trip_id", "stop_sequence",
                    F.col("scheduled_arrival_str").alias("arrival_time"), "stop_name"))


def latest_positions(positions: DataFrame, route: str, n: int = 5) -> DataFrame:
    return (positions.where(F.col("route_id") == route)
            .select("route_id", "recorded_at").orderBy(F.col("recorded_at").desc()).limit(n))


def nearest_gap(arrivals: DataFrame, stop_times: DataFrame, trips: DataFrame, route: str,
                hours: tuple[int, ...] = (0, 1), agency_tz: str | None = None) -> DataFrame:
    """Smallest gap (minutes, 1 dp) between an arrival in ``hours`` and any
    timetable entry of ``route`` at the same stop, at minute resolution.

    Both sides are reduced to their distinct (stop, minute) first: at most
    1,440 arrival and 1,620 timetable minutes per stop meet in the as-of scan,
    however many rows there are. The result is the global minimum.
    """
    at = local_ts("actual_arrival", agency_tz)
    a = (arrivals.where(F.hour(at).isin(*hours))
         .select("stop_id", second_of_day(at, with_seconds=False).alias("a_secs")).distinct())
    t = trips.where(F.col("route_id") == route).select("trip_id")
    s = (stop_times.select("trip_id", "stop_id", "scheduled_arrival_str").join(t, "trip_id")
         .select("stop_id", hms_to_seconds(F.col("scheduled_arrival_str"), False).alias("s_secs"))
         .where(F.col("stop_id").isNotNull() & F.col("s_secs").isNotNull()).distinct())
    m = nearest_asof(a, s, keys=["stop_id"], left_t="a_secs", right_t="s_secs",
                     right_payload=[], window=None, skew_rows=1_000_000, salt_cols=["a_secs"])
    m = pick_nearest(m, "a_secs").where(F.col("_m").isNotNull())
    g = m.agg(F.min(F.abs(F.col("a_secs") - F.col("_m.t"))).cast("long").alias("_g"))
    tenths = int_div(F.col("_g") * 2 + 6, F.lit(12).cast("long"))
    return g.select((tenths.cast("double") / F.lit(10.0)).alias("nearest_gap_min"))


def route_lookup(routes: DataFrame, short_name: str) -> DataFrame:
    """The routes that carry a short name."""
    return routes.where(F.col("route_short_name") == short_name).select("route_id", "route_short_name", "route_long_name")


def route_listing(routes: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` routes by id (a listing with a limit)."""
    return routes.orderBy("route_id").limit(n).select("route_id", "route_short_name", "route_long_name")


def raw_freshness(raw: DataFrame, route: str | None = None) -> DataFrame:
    """Rows, vehicles, polls and reading times of the raw layer, of all routes or one."""
    v = "entity.vehicle"
    if route is not None:
        raw = raw.where(F.col(f"{v}.trip.routeId") == route)
    at = epoch_to_ts(F.col(f"{v}.timestamp"))
    return raw.agg(F.count(F.lit(1)).alias("readings"), F.count_distinct(f"{v}.vehicle.id").alias("vehicles"),
                   F.count_distinct("snapshot_ts").alias("polls"), F.min(at).alias("earliest"), F.max(at).alias("latest"))
