"""Vehicle-position snapshots as nested JSON documents.

A snapshot is one poll of the feed: ``{"header": {"timestamp"}, "entity":
[{"id", "vehicle": {"trip": {"routeId", "tripId"}, "vehicle": {"id"},
"position": {"latitude", "longitude"}, "timestamp"}}]}`` with camelCase keys
and epoch seconds as strings. Files are read with a fixed schema (no
inference pass over the data) and line-delimited, so files split across
tasks; ``multiline=True`` is for pretty-printed input only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

VEHICLE = T.StructType([
    T.StructField("trip", T.StructType([
        T.StructField("routeId", T.StringType()),
        T.StructField("tripId", T.StringType()),
    ])),
    T.StructField("vehicle", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("position", T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ])),
    T.StructField("timestamp", T.StringType()),
])
ENTITY = T.StructType([T.StructField("id", T.StringType()),
                       T.StructField("vehicle", VEHICLE)])
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("header", T.StructType([T.StructField("timestamp", T.StringType())])),
    T.StructField("entity", T.ArrayType(ENTITY)),
])


def entity_struct(pings: DataFrame) -> F.Column:
    """Nested feed entity built from a staged-position row."""
    return F.struct(
        F.concat_ws("-", F.col("vehicle_id"), F.unix_timestamp("recorded_at").cast("string"))
        .alias("id"),
        F.struct(
            F.struct(F.col("route_id").alias("routeId"), F.col("trip_id").alias("tripId"))
            .alias("trip"),
            F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
            F.struct(F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude"))
            .alias("position"),
            F.unix_timestamp("recorded_at").cast("string").alias("timestamp"),
        ).alias("vehicle"),
    )


def snapshot_ts(ts: F.Column) -> F.Column:
    """Poll time of a ping: its minute."""
    return F.date_trunc("minute", ts)


def snapshot_filename(ts: F.Column) -> F.Column:
    """Landing file of a poll: date=YYYY-MM-DD/snapshot_YYYYMMDDTHHMMSSZ.json"""
    return F.concat(F.lit("date="), F.date_format(ts, "yyyy-MM-dd"), F.lit("/snapshot_"),
                    F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"), F.lit(".json"))


def raw_from_pings(pings: DataFrame) -> DataFrame:
    """The raw landing table (one row per entity) for staged pings:
    filename, snapshot_ts, entity."""
    ts = snapshot_ts(F.col("recorded_at"))
    return pings.select(snapshot_filename(ts).alias("filename"), ts.alias("snapshot_ts"),
                        entity_struct(pings).alias("entity"))


def snapshot_documents(pings: DataFrame, document_entities: int = 10_000) -> DataFrame:
    """Feed documents (header + entity list) for staged pings, with ``date``.

    ``document_entities`` is a layout parameter: a poll with more entities is
    written as several documents with the same header time, which is the poll's
    id (counts and the latest poll go by it, not by files), so no single row
    holds an unbounded list. Pings without a time form the poll without a time,
    under a null date.
    """
    ts = snapshot_ts(F.col("recorded_at"))
    p = pings.withColumn("_snap", ts)
    parts = (p.groupBy("_snap").count()
             .select(F.col("_snap").alias("_s"), F.ceil(F.col("count") / F.lit(document_entities)).cast("int").alias("_np")))
    p = (p.join(parts, F.col("_snap").eqNullSafe(F.col("_s"))).drop("_s")
         .withColumn("_part", F.pmod(F.xxhash64("vehicle_id", "recorded_at", "trip_id"), F.col("_np"))))
    return (p.groupBy("_snap", "_part")
            .agg(F.collect_list(entity_struct(p)).alias("entity"))
            .select(F.struct(F.unix_timestamp("_snap").cast("string").alias("timestamp"))
                    .alias("header"),
                    "entity", F.date_format("_snap", "yyyy-MM-dd").alias("date")))


def land_snapshots(docs: DataFrame, path: str, mode: str = "append") -> None:
    """Write documents as line-delimited JSON partitioned by ``date=``."""
    docs.write.mode(mode).partitionBy("date").json(path)


RAW_SCHEMA = T.StructType([T.StructField("filename", T.StringType()),
                           T.StructField("snapshot_ts", T.TimestampType()),
                           T.StructField("date", T.StringType()),
                           T.StructField("entity", ENTITY)])


def docs_to_raw(docs: DataFrame) -> DataFrame:
    """Feed documents -> one row per entity with the source file name and the
    date of its folder (null without one)."""
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/date=(\d{4}-\d{2}-\d{2})/", 1)
    return docs.select(F.col("_metadata.file_path").alias("filename"),
                       F.timestamp_seconds(F.col("header.timestamp").try_cast("long"))
                       .alias("snapshot_ts"), F.when(day != "", day).alias("date"),
                       F.explode("entity").alias("entity"))


def document_reader(reader, multiline: bool, path_glob: str | None, failfast: bool):
    """Snapshot JSON at any depth below a folder; a truncated document fails
    the read, or is left to ``document_quality`` to count."""
    reader = (reader.schema(SNAPSHOT_SCHEMA).option("multiLine", multiline).option("recursiveFileLookup", True)
              .option("mode", "FAILFAST" if failfast else "PERMISSIVE"))
    return reader.option("pathGlobFilter", path_glob) if path_glob else reader


def read_snapshots(spark: SparkSession, path: str, required: bool = True, path_glob: str | None = "*.json",
                   multiline: bool = False, failfast: bool = True) -> DataFrame:
    """Raw landing table: filename, snapshot_ts, date, entity (one row per
    entity; an empty entity list gives no row), from files at any depth. A
    missing optional path gives an empty table; a missing required path raises."""
    try:
        docs = document_reader(spark.read, multiline, path_glob, failfast).json(path)
    except AnalysisException as e:
        if required or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_SCHEMA)
    return docs_to_raw(docs)


def document_quality(spark: SparkSession, path: str, path_glob: str | None = "*.json") -> DataFrame:
    """What a tolerant read of the landing folder would lose: documents,
    corrupt ones, entities, and entities whose latitude, longitude or time is
    there but does not parse (one row)."""
    reader = spark.read.option("recursiveFileLookup", True)
    lines = (reader.option("pathGlobFilter", path_glob) if path_glob else reader).text(path).where("trim(value) <> ''")
    # every value of the document as text, so that a failed cast shows
    loose = ("header struct<timestamp:string>, entity array<struct<id:string,vehicle:struct<"
             "position:struct<latitude:string,longitude:string>,timestamp:string>>>, _corrupt string")
    docs = lines.select(F.from_json("value", loose, {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"))

    def failed(get, kind):
        return F.size(F.filter("d.entity", lambda e: get(e).isNotNull() & get(e).try_cast(kind).isNull()))
    v = "vehicle"
    return (docs.agg(
        F.count(F.lit(1)).alias("documents"), F.count("d._corrupt").alias("corrupt_documents"),
        F.coalesce(F.sum(F.when(F.col("d._corrupt").isNull(), F.coalesce(F.size("d.entity"), F.lit(0)))), F.lit(0)).alias("entities"),
        *[F.coalesce(F.sum(F.when(F.col("d._corrupt").isNull(), F.coalesce(failed(get, kind), F.lit(0)))), F.lit(0)).alias(f"bad_{name}") for name, get, kind in (
            ("latitude", lambda e: e[v]["position"]["latitude"], "double"),
            ("longitude", lambda e: e[v]["position"]["longitude"], "double"),
            ("time", lambda e: e[v]["timestamp"], "long"))]))


def stream_snapshots(spark: SparkSession, path: str, max_files: int = 30,
                     path_glob: str | None = "*.json") -> DataFrame:
    """Streaming raw landing table over a landing folder; each micro-batch
    takes at most ``max_files`` new files."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return docs_to_raw(document_reader(reader, False, path_glob, True).json(path))


def latest_snapshot(raw: DataFrame, route: str | None = None) -> DataFrame:
    """Entities of the most recent poll, optionally for one route."""
    return _of_poll(raw, raw.select(F.max("snapshot_ts")).scalar(), route)


def day_folders(spark: SparkSession, path: str) -> list[str]:
    """The ``date=`` folders of a landing folder, newest day first, from one
    listing of the folder itself: no file is listed or opened."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    return [f"{path}/{n}" for n in sorted(names, reverse=True) if re.fullmatch(r"date=\d{4}-\d{2}-\d{2}", n)]


def newest_poll(spark: SparkSession, path: str, route: str | None = None, path_glob: str | None = "*.json") -> DataFrame:
    """``latest_snapshot`` of a landing folder whose documents lie in the folder of
    their poll's day (as ``land_snapshots`` writes them), reading only the newest
    day that holds a poll, however long the history is. A day whose documents have
    no entity or no poll time is passed over for the one before; without any poll
    the result is empty."""
    for folder in day_folders(spark, path):
        raw = read_snapshots(spark, folder, required=False, path_glob=path_glob)
        last = raw.agg(F.max("snapshot_ts")).first()[0]
        if last is not None:
            return _of_poll(raw, F.lit(last), route)
    return _of_poll(spark.createDataFrame([], RAW_SCHEMA), F.lit(None).cast("timestamp"), route)


def _of_poll(raw: DataFrame, time: Column, route: str | None) -> DataFrame:
    r = raw.where(F.col("snapshot_ts") == time)
    if route is not None:
        r = r.where(F.col("entity.vehicle.trip.routeId") == route)
    v = "entity.vehicle"
    return r.select(F.col(f"{v}.vehicle.id").alias("vehicle_id"),
                    F.col(f"{v}.trip.routeId").alias("route_id"),
                    F.col(f"{v}.trip.tripId").alias("trip_id"),
                    F.col(f"{v}.position.latitude").alias("latitude"),
                    F.col(f"{v}.position.longitude").alias("longitude"))
