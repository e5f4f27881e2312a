"""Transit-shaped views derived from the driver's parquet tables.

The driver tables hold no transit data, so stops, trips, stop times and
vehicle pings are derived from ``nation``, ``region``, ``orders``,
``lineitem`` and ``events`` by fixed formulas. Every registered query reads
these, so its work grows with the input tables.

Fixed values (shared with the DuckDB oracle): stop grid origin 43.6 / -79.4,
stop spacing 0.0008 deg latitude, route spacing 0.01 deg longitude, route ids
100 + key % 5, stop ids 1000 + ..., time origin 1704067200 (2024-01-01 UTC),
ping time compressed 20x, 64 events per trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

T0 = 1704067200
TIME_COMPRESSION = 20
EVENTS_PER_TRIP = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, listed anew by every query."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged stops: stop_id, stop_name, stop_latitude, stop_longitude."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        (F.lit(1000) + F.col("n_nationkey")).cast("string").alias("stop_id"),
        F.concat(F.lit("Stop "), F.col("n_name")).alias("stop_name"),
        F.expr("cast(43.6 + 0.0008 * (n_nationkey div 5) as double)").alias("stop_latitude"),
        F.expr("cast(-79.4 + 0.01 * n_regionkey as double)").alias("stop_longitude"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged routes: route_id, route_short_name, route_long_name."""
    r = table(spark, sf_dir, "region")
    rid = (F.lit(100) + F.col("r_regionkey")).cast("string")
    return r.select(rid.alias("route_id"), rid.alias("route_short_name"),
                    F.col("r_name").alias("route_long_name"))


def trips(spark: SparkSession, sf_dir: str, routes: int = 5) -> DataFrame:
    """Staged trips: trip_id, route_id, service_id, trip_headsign, direction_id.
    ``routes`` (a multiple of five) is the number of routes they are dealt to."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        (F.lit(100) + F.col("o_custkey") % routes).cast("string").alias("route_id"),
        F.col("o_orderpriority").alias("service_id"),
        F.col("o_orderstatus").alias("trip_headsign"),
        (F.col("o_custkey") % 2).cast("int").alias("direction_id"),
    )


def _two(c):
    return F.lpad(c.cast("string"), 2, "0")


def _by_trip(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """``cols`` with the order key as the trip id. Joins by the trip id itself leave
    rows dealt by it, so joins and windows by trip don't deal them again."""
    return df.select(F.col(key).cast("string").alias("trip_id"), *cols)


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged stop times; schedule hours run 00..26."""
    li = _by_trip(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    j = li.join(_by_trip(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey"), "trip_id")
    hms = F.concat(_two(F.col("l_partkey") % 27), F.lit(":"),
                   _two(F.col("l_suppkey") * 7 % 60), F.lit(":"),
                   _two((F.col("l_partkey") + F.col("l_suppkey")) % 60))
    return j.select(
        "trip_id",
        (F.lit(1000) + (F.col("l_linenumber") % 5) * 5 + F.col("o_custkey") % 5)
        .cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("int").alias("stop_sequence"),
        hms.alias("scheduled_arrival_str"),
        hms.alias("scheduled_departure_str"),
    )


def pings(spark: SparkSession, sf_dir: str, routes: int = 5) -> DataFrame:
    """Staged vehicle positions: route_id, trip_id, vehicle_id, latitude,
    longitude, recorded_at. NULL trip ids occur (error events)."""
    e = table(spark, sf_dir, "events")
    secs = F.lit(T0) + F.expr(
        f"(unix_timestamp(ts) - {T0}) div {TIME_COMPRESSION}")
    return e.select(
        (F.lit(100) + F.col("user_id") % routes).cast("string").alias("route_id"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"),
                            F.expr(f"event_id div {EVENTS_PER_TRIP}").cast("string")))
        .alias("trip_id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.expr("cast(43.6 + 0.0008 * (event_id % 5) as double)"
               " + ((event_id * 37) % 140 - 70) / 111000.0D").alias("latitude"),
        F.expr("cast(-79.4 + 0.01 * (user_id % 5) as double)").alias("longitude"),
        F.timestamp_seconds(secs).alias("recorded_at"),
    )


def stop_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map layer's stop table: stop_id, stop_lat, stop_lon."""
    s = stops(spark, sf_dir)
    return s.select("stop_id", F.col("stop_latitude").alias("stop_lat"),
                    F.col("stop_longitude").alias("stop_lon"))


def raw_strings(df: DataFrame) -> DataFrame:
    """Every column as a string, like an all-varchar CSV load."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def raw_gtfs(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """GTFS-file-shaped raw tables (original column names, all strings)."""
    if name == "stops":
        s = stops(spark, sf_dir)
        return raw_strings(s.select("stop_id", "stop_name",
                                    F.col("stop_latitude").alias("stop_lat"),
                                    F.col("stop_longitude").alias("stop_lon")))
    if name == "stop_times":
        st = stop_times(spark, sf_dir)
        return raw_strings(st.select("trip_id", "stop_id", "stop_sequence",
                                     F.col("scheduled_arrival_str").alias("arrival_time"),
                                     F.col("scheduled_departure_str").alias("departure_time")))
    if name == "trips":
        return raw_strings(trips(spark, sf_dir))
    if name == "routes":
        return raw_strings(routes(spark, sf_dir))
    raise ValueError(f"unknown GTFS table {name!r}")


def schedule_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two published versions of the timetable, for change capture.

    Version 1 lacks the rows of line items flagged 'A' (they are added in
    version 2); version 2 lacks the rows flagged 'R' (removed) and moves the
    time of every first stop (line number 1) by one minute.
    """
    li = _by_trip(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    j = li.join(_by_trip(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey"), "trip_id")

    def hms(minute):
        return F.concat(_two(F.col("l_partkey") % 27), F.lit(":"), _two(minute), F.lit(":"),
                        _two((F.col("l_partkey") + F.col("l_suppkey")) % 60))

    base = j.select(
        "trip_id",
        (F.lit(1000) + (F.col("l_linenumber") % 5) * 5 + F.col("o_custkey") % 5)
        .cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("int").alias("stop_sequence"),
        hms(F.col("l_suppkey") * 7 % 60).alias("t1"),
        hms((F.col("l_suppkey") * 7 + 1) % 60).alias("talt"),
        "l_returnflag", "l_linenumber")
    # line items repeat their order and line number: the n-th of equal ones is told apart
    nth = Window.partitionBy("trip_id", "stop_id", "stop_sequence").orderBy("t1", "talt", "l_returnflag")
    base = base.withColumn("occurrence", F.row_number().over(nth))
    time2 = F.when(F.col("l_linenumber") == 1, F.col("talt")).otherwise(F.col("t1"))
    # published once: the runs read the versions, not the tables they come from
    path = scratch_path(spark, "timetable")
    base.write.parquet(path)
    base = spark.read.schema(base.schema).parquet(path)
    key = ["trip_id", "stop_id", "stop_sequence", "occurrence"]
    v1 = base.where(F.col("l_returnflag") != "A").select(*key, F.col("t1").alias("scheduled_arrival_str"))
    v2 = base.where(F.col("l_returnflag") != "R").select(*key, time2.alias("scheduled_arrival_str"))
    return v1, v2
