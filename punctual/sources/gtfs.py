"""Static timetable files (GTFS CSV) and Parquet.

Raw tables keep every column as a string (no inference pass over the data,
lossless); staging casts. Optional files yield ``None`` when absent,
required ones raise. Quoting follows RFC 4180: a quote inside a quoted field is
doubled, and a quoted field may hold line breaks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the standard file names
GTFS_FILES = {"routes": "routes.txt", "trips": "trips.txt", "stops": "stops.txt",
              "stop_times": "stop_times.txt"}


def missing_path(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def first_file(spark: SparkSession, folder: str, name: str) -> str | None:
    """The first file (by path) of that name at any depth; None without one.
    Only the listing is read."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", name).load(folder).select("path"))
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return None
    return files.agg(F.min("path")).first()[0]


def read_gtfs(spark: SparkSession, gtfs_dir: str, name: str, required: bool = False,
              multiline: bool = True) -> DataFrame | None:
    """All-string CSV table ``name``: ``gtfs_dir/<file>`` (a file or a folder of
    parts), else the first file of that name below ``gtfs_dir``. ``multiline``
    allows line breaks in quoted fields (such a file isn't split); turn it off
    for large files without them."""
    fname = GTFS_FILES.get(name, name)
    base = (spark.read.option("header", True).option("inferSchema", False)
            .option("quote", '"').option("escape", '"').option("multiLine", multiline))
    try:
        return base.csv(f"{gtfs_dir.rstrip('/')}/{fname}")
    except AnalysisException as e:
        if not missing_path(e):
            raise
    if (path := first_file(spark, gtfs_dir, fname)) is not None:
        return base.csv(path)
    if required:
        raise FileNotFoundError(f"{fname} is not in {gtfs_dir}")
    return None


def write_gtfs(df: DataFrame, gtfs_dir: str, name: str) -> str:
    """Write a raw table as a header CSV folder named after the GTFS file."""
    path = f"{gtfs_dir.rstrip('/')}/{GTFS_FILES.get(name, name)}"
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path
