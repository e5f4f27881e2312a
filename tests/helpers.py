"""Row comparison and tiny-input builders for tests."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import types as T


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if hasattr(v, "item"):          # numpy scalars
        return norm(v.item())
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


STOPS = T.StructType([T.StructField("stop_id", T.StringType()),
                      T.StructField("stop_name", T.StringType()),
                      T.StructField("stop_latitude", T.DoubleType()),
                      T.StructField("stop_longitude", T.DoubleType())])
TRIPS = T.StructType([T.StructField("trip_id", T.StringType()),
                      T.StructField("route_id", T.StringType()),
                      T.StructField("service_id", T.StringType()),
                      T.StructField("trip_headsign", T.StringType()),
                      T.StructField("direction_id", T.IntegerType())])
STOP_TIMES = T.StructType([T.StructField("trip_id", T.StringType()),
                           T.StructField("stop_id", T.StringType()),
                           T.StructField("stop_sequence", T.IntegerType()),
                           T.StructField("scheduled_arrival_str", T.StringType()),
                           T.StructField("scheduled_departure_str", T.StringType())])
PINGS = T.StructType([T.StructField("route_id", T.StringType()),
                      T.StructField("trip_id", T.StringType()),
                      T.StructField("vehicle_id", T.StringType()),
                      T.StructField("latitude", T.DoubleType()),
                      T.StructField("longitude", T.DoubleType()),
                      T.StructField("recorded_at", T.TimestampType())])
ROUTES = T.StructType([T.StructField("route_id", T.StringType()),
                       T.StructField("route_short_name", T.StringType()),
                       T.StructField("route_long_name", T.StringType())])


def inputs(spark, stops, trips, stop_times, pings):
    from punctual.plans.transit import Inputs
    st = [(a, b, c, d, d) for (a, b, c, d) in stop_times]
    return Inputs(stops=spark.createDataFrame(stops, STOPS),
                  trips=spark.createDataFrame(trips, TRIPS),
                  stop_times=spark.createDataFrame(st, STOP_TIMES),
                  routes=spark.createDataFrame([], ROUTES),
                  pings=spark.createDataFrame(pings, PINGS))


M_LAT = 111000.0


def north(lat: float, metres: float) -> float:
    """Latitude ``metres`` north of ``lat`` on the planar model."""
    return lat + metres / M_LAT
