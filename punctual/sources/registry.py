"""Feed files whose schema grows: discovery, widening, rescue (S1, U-1).

A registry (a log table, one row per landed file) holds the shape of each file.
A load lists the folder (names only), reads just the files that the registry
lacks, derives each one's shape in one distributed aggregate over its documents
and commits them. The table's schema is the merge of all different shapes:
fields by name in order of appearance, numbers widened, values of unlike types as
text. Files are then read by name with that schema; a field that a file lacks is
NULL. A reader that must keep a fixed schema gets the fields it doesn't know
in a rescue column instead of losing them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tablelog import LogTable

RESCUED = "_rescued"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds values of both; text for unlike types."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b}
        mine = [T.StructField(f.name, merge_types(f.dataType, other.pop(f.name, T.NullType()))) for f in a]
        return T.StructType([*mine, *[T.StructField(n, t) for n, t in other.items()]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, (*_WHOLE, T.DoubleType)) and isinstance(b, (*_WHOLE, T.DoubleType)):
        return T.DoubleType()
    return T.StringType()


def settled(kind: T.DataType, last: bool = False) -> T.DataType:
    """A discovered type as a column type: fractions as doubles, values of unlike
    types as text; ``last``: fields that were null in all files as text too."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, settled(f.dataType, last)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(settled(kind.elementType, last))
    if isinstance(kind, T.DecimalType):
        return T.LongType() if kind.scale == 0 and kind.precision <= 18 else T.DoubleType()
    return T.StringType() if isinstance(kind, T.VariantType) or last and isinstance(kind, T.NullType) else kind


def _plain(path) -> F.Column:
    return F.regexp_replace(path, "^file:/+", "file:///")


def registry(spark: SparkSession, path: str) -> LogTable:
    return LogTable(spark, path, ["file"])


def register(spark: SparkSession, landing: str, path: str, path_glob: str = "*.json") -> int:
    """Add the shapes of the landed files that the registry at ``path`` lacks;
    returns how many there were. Documents are line-delimited; a file with
    blank lines only has the empty shape, one without any byte isn't listed."""
    table = registry(spark, path)
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", path_glob)
             .load(landing).select(_plain("path").alias("file")))
    known = table.read()
    if known is not None:
        found = found.join(known.select("file"), "file", "left_anti")
    new = [r.file for r in found.collect()]  # names of one load's files
    if not new:
        return 0
    lines = spark.read.text(new).select(_plain("_metadata.file_path").alias("file"), "value")
    shapes = (lines.where(F.trim("value") != "").groupBy("file")
              .agg(F.schema_of_variant_agg(F.parse_json("value")).alias("shape")))
    listed = spark.createDataFrame([(f,) for f in new], "file string")
    table.upsert(listed.join(shapes, "file", "left").select("file", F.coalesce("shape", F.lit("OBJECT<>")).alias("shape")))
    return len(new)


def shape_type(shape: str) -> T.DataType:
    """The type that a discovered shape text names."""
    return T.StructType() if shape == "OBJECT<>" else settled(T._parse_datatype_string(shape.replace("OBJECT<", "STRUCT<")))


def merged_schema(spark: SparkSession, path: str) -> T.StructType:
    """The merge of all registered shapes (there are few different ones), in order
    of their first file."""
    table = registry(spark, path).read()
    if table is None:
        return T.StructType()
    shapes = table.groupBy("shape").agg(F.min("file").alias("first")).orderBy("first").collect()
    return settled(reduce(merge_types, [shape_type(r.shape) for r in shapes], T.StructType()), last=True)


def read_merged(spark: SparkSession, landing: str, path: str, path_glob: str = "*.json") -> DataFrame:
    """All landed documents, columns matched by name, with the merged schema."""
    register(spark, landing, path, path_glob)
    return (spark.read.schema(merged_schema(spark, path)).option("recursiveFileLookup", True)
            .option("pathGlobFilter", path_glob).json(landing))


def read_fixed(spark: SparkSession, landing: str, schema: T.StructType, path_glob: str = "*.json") -> DataFrame:
    """All landed documents with a fixed schema; ``_rescued`` maps the top-level
    fields that the schema lacks, and those whose value doesn't fit their type,
    to their JSON text (NULL if there are none)."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", path_glob).text(landing).where(F.trim("value") != "")
    doc, fields = F.from_json("value", schema), F.from_json("value", "map<string,string>")
    both = lines.select(doc.alias("d"), fields.alias("m"))
    names = F.array(*[F.lit(f.name) for f in schema]) if schema.fields else F.array().cast("array<string>")
    unfit = F.array_compact(F.array(*[F.when(F.col(f"d.{f.name}").isNull(), F.lit(f.name)) for f in schema])) if schema.fields else names
    rest = F.map_filter("m", lambda k, v: v.isNotNull() & (~F.array_contains(names, k) | F.array_contains(unfit, k)))
    return both.select("d.*", F.when(F.size(rest) > 0, rest).alias(RESCUED))
