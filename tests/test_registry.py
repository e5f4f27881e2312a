"""Schema discovery, widening and rescue on files of different shapes."""

from __future__ import annotations

import json
import os
import tempfile

import duckdb
from pyspark.sql import types as T

from punctual.sources import registry as reg


def land(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.writelines(json.dumps(d) + "\n" for d in docs)


def test_merged_files_equal_union_by_name(spark):
    top = tempfile.mkdtemp(prefix="punctual-test-")
    landing, path = f"{top}/in", f"{top}/registry"
    land(f"{landing}/a", "1.json", [{"id": 1, "x": 5, "v": {"lat": 1}}, {"id": 2}])
    assert reg.register(spark, landing, path) == 1 and reg.register(spark, landing, path) == 0
    land(f"{landing}/b", "2.json", [{"id": 3, "x": 1.5, "v": {"lat": 2.5, "lon": 3.25}, "tag": "t"}])
    land(f"{landing}/b", "3.json", [{"x": None, "id": 4, "list": [1, 2]}, {"id": 5, "list": [], "flag": True}])
    land(f"{landing}/b", "4.json", [])
    with open(f"{landing}/b/5.json", "w") as f:
        f.write("\n\n")
    land(f"{landing}/b", "other.txt", [{"no": 1}])
    got = reg.read_merged(spark, landing, path)
    assert registered(spark, path) == 4
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "id": "bigint", "v": "struct<lat:double,lon:double>", "x": "double", "tag": "string", "flag": "boolean", "list": "array<bigint>"}
    con = duckdb.connect()
    want = con.execute(f"""select id, x, tag, flag, list, v.lat lat, v.lon lon from read_json('{landing}/*/*.json', format='newline_delimited', union_by_name=true)
                           order by id""").fetchall()
    mine = [tuple(r) for r in got.selectExpr("id", "x", "tag", "flag", "list", "v.lat", "v.lon").orderBy("id").collect()]
    assert mine == [tuple(r) for r in want]


def registered(spark, path):
    return reg.registry(spark, path).read().count()


def test_unlike_types_become_text(spark):
    top = tempfile.mkdtemp(prefix="punctual-test-")
    land(f"{top}/in", "1.json", [{"a": 1, "b": [1], "c": {"d": 1}}])
    land(f"{top}/in", "2.json", [{"a": "x", "b": {"e": 2}, "c": {"d": "y", "f": None}}])
    rows = reg.read_merged(spark, f"{top}/in", f"{top}/registry").collect()
    assert sorted((r.a, r.b, r.c.d, r.c.f) for r in rows) == [("1", "[1]", "1", None), ("x", '{"e": 2}', "y", None)]
    assert reg.merge_types(T.NullType(), T.LongType()) == T.LongType()
    assert reg.merge_types(T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())) == T.ArrayType(T.DoubleType())


def test_fixed_schema_rescues_the_rest(spark):
    top = tempfile.mkdtemp(prefix="punctual-test-")
    land(f"{top}/in", "1.json", [{"id": 1, "x": 2}, {"id": 2, "x": "two", "new": {"k": [1]}, "gone": None}, {"y": True}])
    got = reg.read_fixed(spark, f"{top}/in", T.StructType().add("id", "long").add("x", "long"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 2, None), (2, None, {"x": "two", "new": '{"k":[1]}'}), (None, None, {"y": "true"})], key=repr)
    assert reg.merged_schema(spark, f"{top}/none") == T.StructType()
