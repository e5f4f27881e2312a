"""Staging: flatten raw snapshots, rename and cast raw timetable columns
(S3, P1-P4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import epoch_to_ts

POSITION_COLS = ["route_id", "trip_id", "vehicle_id", "latitude", "longitude", "recorded_at"]


def explode_entities(raw_docs: DataFrame) -> DataFrame:
    """One row per vehicle entity; an empty ``entity`` list yields no row."""
    keep = [c for c in ("filename", "snapshot_ts", "date") if c in raw_docs.columns]
    return raw_docs.select(*keep, F.explode("entity").alias("entity"))


def flatten_positions(raw: DataFrame) -> DataFrame:
    """Nested entity -> route_id, trip_id, vehicle_id, latitude, longitude,
    recorded_at. Missing structs give NULLs."""
    v = "entity.vehicle"
    return raw.select(
        F.col(f"{v}.trip.routeId").alias("route_id"),
        F.col(f"{v}.trip.tripId").alias("trip_id"),
        F.col(f"{v}.vehicle.id").alias("vehicle_id"),
        F.col(f"{v}.position.latitude").cast("double").alias("latitude"),
        F.col(f"{v}.position.longitude").cast("double").alias("longitude"),
        epoch_to_ts(F.col(f"{v}.timestamp")).alias("recorded_at"),
    )


def stage_stops(raw: DataFrame) -> DataFrame:
    return raw.select("stop_id", "stop_name",
                      F.col("stop_lat").try_cast("double").alias("stop_latitude"),
                      F.col("stop_lon").try_cast("double").alias("stop_longitude"))


def stage_trips(raw: DataFrame) -> DataFrame:
    return raw.select("trip_id", "route_id", "service_id", "trip_headsign",
                      F.col("direction_id").try_cast("int").alias("direction_id"))


def stage_routes(raw: DataFrame) -> DataFrame:
    return raw.select("route_id", "route_short_name", "route_long_name")


def stage_stop_times(raw: DataFrame) -> DataFrame:
    """Times stay raw strings; hours may exceed 23."""
    return raw.select("trip_id", "stop_id",
                      F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
                      F.col("arrival_time").alias("scheduled_arrival_str"),
                      F.col("departure_time").alias("scheduled_departure_str"))
