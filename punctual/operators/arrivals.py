"""Reconstruct stop arrivals from vehicle pings.

Physical plan, per step:

* ``route_stops``: distinct (route, stop) pairs are aggregated from the
  stop-time/trip join *before* stop attributes are attached, so the wide
  side is reduced by a partial (map-side) aggregate.
* ``proximity_join``: pings are joined on ``(route_id, grid cell)`` with the
  route's stops replicated into the 3x3 neighbourhood of their cell. With a
  cell edge longer than the radius the join is exact, and a route holding a
  third of all pings is spread over all its cells. The stop grid is broadcast
  only after its size is checked; above the bound the join shuffles on
  (route, cell), so no single route lands in one task.
* ``nearest_stop``: one row per ping key by a ``min(struct(...))`` aggregate
  (partial aggregation before the shuffle collapses each ping's candidates
  where they were produced).
* ``actual_arrivals``: ``min`` aggregates with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.geo import grid_cell, planar_distance_m
from ..functions.timefns import local_ts
from .joins import broadcast_if_small

ROUTE_STOP_COLS = ["route_id", "stop_id", "stop_name", "stop_latitude", "stop_longitude"]
CANDIDATE_COLS = ["vehicle_id", "route_id", "trip_id", "recorded_at", "stop_id",
                  "stop_name", "distance_m"]


def route_stops(stops: DataFrame, stop_times: DataFrame, trips: DataFrame,
                target_route: str | None = None) -> DataFrame:
    """Every stop served by each route, with its name and coordinates."""
    t = trips.select("trip_id", "route_id")
    if target_route is not None:
        t = t.where(F.col("route_id") == target_route)
    pairs = (stop_times.select("trip_id", "stop_id")
             .join(t, "trip_id")
             .select("route_id", "stop_id")
             .distinct())
    return (pairs.join(stops.select("stop_id", "stop_name", "stop_latitude", "stop_longitude"),
                       "stop_id")
            .select(*ROUTE_STOP_COLS)
            .distinct())


def stop_grid(rs: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Route stops replicated into the 3x3 grid cells around their own cell."""
    cell_m = cfg.radius_m + 1.0   # strictly wider than the radius: exact
    off = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return (rs.where(F.col("stop_latitude").isNotNull() & F.col("stop_longitude").isNotNull())
            .withColumn("cy0", grid_cell(F.col("stop_latitude"), cfg.m_lat, cell_m))
            .withColumn("cx0", grid_cell(F.col("stop_longitude"), cfg.m_lon, cell_m))
            .withColumn("dy", F.explode(off))
            .withColumn("dx", F.explode(off))
            .select("route_id", (F.col("cy0") + F.col("dy")).alias("cell_y"),
                    (F.col("cx0") + F.col("dx")).alias("cell_x"),
                    "stop_id", "stop_name", "stop_latitude", "stop_longitude"))


def proximity_join(pings: DataFrame, rs: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """Candidate (ping, stop) pairs on the ping's own route within the radius."""
    cfg = cfg or PipelineConfig()
    p = pings.select("vehicle_id", "route_id", "trip_id", "latitude", "longitude", "recorded_at")
    if cfg.target_route is not None:
        p = p.where(F.col("route_id") == cfg.target_route)
        rs = rs.where(F.col("route_id") == cfg.target_route)
    cell_m = cfg.radius_m + 1.0
    p = (p.withColumn("cell_y", grid_cell(F.col("latitude"), cfg.m_lat, cell_m))
          .withColumn("cell_x", grid_cell(F.col("longitude"), cfg.m_lon, cell_m)))
    side = broadcast_if_small(stop_grid(rs, cfg), cfg.scale.broadcast_max_bytes)
    j = p.join(side, ["route_id", "cell_y", "cell_x"])
    dist = planar_distance_m(F.col("latitude"), F.col("longitude"),
                             F.col("stop_latitude"), F.col("stop_longitude"),
                             cfg.m_lat, cfg.m_lon)
    return (j.withColumn("distance_m", dist)
             .where(F.col("distance_m") <= F.lit(cfg.radius_m))
             .select(*CANDIDATE_COLS))


def nearest_stop(candidates: DataFrame) -> DataFrame:
    """The closest stop per (vehicle, trip, ping time); ties -> lowest stop_id."""
    best = F.min(F.struct("distance_m", "stop_id", "route_id", "stop_name")).alias("b")
    return (candidates.groupBy("vehicle_id", "trip_id", "recorded_at").agg(best)
            .select("vehicle_id", F.col("b.route_id").alias("route_id"), "trip_id",
                    "recorded_at", F.col("b.stop_id").alias("stop_id"),
                    F.col("b.stop_name").alias("stop_name"),
                    F.col("b.distance_m").alias("distance_m")))


def actual_arrivals(nearest: DataFrame, by_service_date: bool = False,
                    agency_tz: str | None = None) -> DataFrame:
    """First time each vehicle/trip was nearest to each stop.

    ``closest_distance_m`` is the minimum over the group, independent of the
    arrival ping. With ``by_service_date`` the arrival grain includes the
    calendar date (in the agency's zone), so a trip id reused on another day is a new arrival.
    """
    keys = ["vehicle_id", "route_id", "trip_id", "stop_id", "stop_name"]
    df = nearest
    if by_service_date:
        df = df.withColumn("service_date", F.to_date(local_ts("recorded_at", agency_tz)))
        keys = keys + ["service_date"]
    out = df.groupBy(*keys).agg(F.min("recorded_at").alias("actual_arrival"),
                                F.min("distance_m").alias("closest_distance_m"))
    return out.select(*keys, "actual_arrival", "closest_distance_m")
