"""Sources, sinks and streaming on hand-made inputs."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from punctual.operators import quality as dq
from punctual.operators.staging import flatten_positions
from punctual.sinks import materialize as mat
from punctual.sources import snapshots as snap
from tests.helpers import ts


def _fresh():
    return tempfile.mkdtemp(prefix="punctual-test-")


def _fact_rows(spark, rows):
    schema = "trip_stop_id string, actual_arrival timestamp, delay_minutes double"
    return spark.createDataFrame(rows, schema)


def test_incremental_append_mark_semantics(spark):
    path = os.path.join(_fresh(), "fact")
    first = _fact_rows(spark, [("a", ts("2024-01-01 10:00:00"), 1.0),
                               ("b", ts("2024-01-01 11:00:00"), 2.0)])
    assert mat.append_incremental(spark, first, path) == 2          # empty target: full build
    second = _fact_rows(spark, [("b", ts("2024-01-01 11:00:00"), 9.0),   # equal to mark: no
                                ("c", ts("2024-01-01 12:00:00"), 3.0),   # later: yes
                                ("late", ts("2024-01-01 09:00:00"), 4.0)])  # earlier: no
    assert mat.append_incremental(spark, second, path) == 1
    got = {r.trip_stop_id: r.delay_minutes for r in spark.read.parquet(path).collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 3.0}
    third = _fact_rows(spark, [("late", ts("2024-01-01 09:00:00"), 4.0),
                               ("c", ts("2024-01-01 12:00:00"), 3.5)])   # same key: replaced
    n = mat.append_incremental(spark, third, path, lookback=dt.timedelta(hours=4))
    assert n == 2
    got = {r.trip_stop_id: r.delay_minutes for r in spark.read.parquet(path).collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 3.5, "late": 4.0}


def test_scd2_changed_unchanged_new_deleted(spark):
    schema = "trip_id string, stop_id string, stop_sequence int, scheduled_arrival_str string"
    v1 = spark.createDataFrame([("1", "23", 1, "10:00:00"), ("12", "3", 1, "11:00:00"),
                                ("9", "9", 1, "12:00:00")], schema)
    v2 = spark.createDataFrame([("1", "23", 1, "10:00:00"), ("12", "3", 1, "11:05:00"),
                                ("7", "7", 1, "13:00:00")], schema)
    key, chk = ["trip_id", "stop_id", "stop_sequence"], ["scheduled_arrival_str"]
    t1, t2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    for hard in (False, True):
        path = os.path.join(_fresh(), "snap")
        mat.scd2_snapshot(spark, v1, path, key, chk, t1, invalidate_hard_deletes=hard)
        mat.scd2_snapshot(spark, v2, path, key, chk, t2, invalidate_hard_deletes=hard)
        got = sorted((r.trip_id, r.scheduled_arrival_str, str(r.valid_from)[:10],
                      None if r.valid_to is None else str(r.valid_to)[:10])
                     for r in mat.read_scd2(spark, path).collect())
        deleted_to = "2024-01-02" if hard else None
        assert got == sorted([("1", "10:00:00", "2024-01-01", None),
                              ("12", "11:00:00", "2024-01-01", "2024-01-02"),
                              ("12", "11:05:00", "2024-01-02", None),
                              ("9", "12:00:00", "2024-01-01", deleted_to),
                              ("7", "13:00:00", "2024-01-02", None)])


def test_snapshot_json_edge_cases(spark):
    d = _fresh()
    os.makedirs(os.path.join(d, "date=2024-01-01"))
    docs = [
        {"header": {"timestamp": "1704103200"}, "entity": []},
        {"header": {"timestamp": "1704103230"}, "entity": [
            {"id": "e1", "vehicle": {"vehicle": {"id": "V1"},
                                     "position": {"latitude": 43.6, "longitude": -79.4},
                                     "timestamp": "1704103229"}},
            {"id": "e2", "vehicle": {"trip": {"routeId": "102", "tripId": "T9"},
                                     "vehicle": {"id": "V2"},
                                     "position": {"latitude": 43.7, "longitude": -79.3},
                                     "timestamp": "1704103230"}}]},
    ]
    for i, doc in enumerate(docs):
        with open(os.path.join(d, "date=2024-01-01", f"snapshot_{i}.json"), "w") as fh:
            fh.write(json.dumps(doc) + "\n")
    raw = snap.read_snapshots(spark, d)
    assert raw.count() == 2                                   # empty entity list: no row
    pos = {r.vehicle_id: r for r in flatten_positions(raw).collect()}
    assert pos["V1"].route_id is None and pos["V1"].trip_id is None
    assert pos["V2"].recorded_at == dt.datetime(2024, 1, 1, 10, 0, 30)
    latest = snap.latest_snapshot(raw, route="102").collect()
    assert [r.vehicle_id for r in latest] == ["V2"]
    assert snap.read_snapshots(spark, os.path.join(d, "nope"), required=False).count() == 0
    with pytest.raises(AnalysisException):
        snap.read_snapshots(spark, os.path.join(d, "nope"), required=True)


def test_newest_poll_reads_one_day_of_any_history(spark, tmp_path):
    def land(day, name, ts, vehicle):
        entity = [] if vehicle is None else [{"id": "e", "vehicle": {"trip": {"routeId": vehicle[-1]}, "vehicle": {"id": vehicle}}}]
        os.makedirs(tmp_path / day, exist_ok=True)
        with open(tmp_path / day / name, "w") as fh:
            fh.write(json.dumps({"header": {"timestamp": ts}, "entity": entity}) + "\n")

    noon = 1704110400  # 2024-01-01 12:00 UTC
    assert snap.newest_poll(spark, str(tmp_path / "nope")).count() == 0
    seen = []
    for day in range(6):
        for k in range(3):
            land(f"date=2024-01-0{day + 1}", f"s{k}.json", str(noon + day * 86400 + 60 * k), f"V{day}{k}")
        land(f"date=2024-01-0{day + 1}", "again.json", str(noon + day * 86400 + 120), f"W{day}5")  # the same poll in two files
        got = snap.newest_poll(spark, str(tmp_path))
        every = snap.latest_snapshot(snap.read_snapshots(spark, str(tmp_path)))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.collect()))
        seen.append(len(got.inputFiles()))
    assert seen == [4] * 6
    assert [r.vehicle_id for r in snap.newest_poll(spark, str(tmp_path), route="5").collect()] == ["W55"]
    # newer days without a poll, and folders that are no days
    land("date=2024-01-07", "empty.json", str(noon + 6 * 86400), None)
    land("date=2024-01-08", "blank.json", None, "V9")
    land("date=__HIVE_DEFAULT_PARTITION__", "lost.json", None, "V9")
    assert sorted(r.vehicle_id for r in snap.newest_poll(spark, str(tmp_path)).collect()) == ["V52", "W55"]


def test_quality_checks_count_violations(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 40.0), ("b", -30.0)],
                               "k string, x double")
    res = {(r.column_name, r.test): r.violations for r in dq.run_checks(
        df, "t", [dq.not_null("k"), dq.unique("k"), dq.accepted_range("x", -30, 30)]).collect()}
    assert res == {("k", "not_null"): 1, ("k", "unique"): 1, ("x", "accepted_range"): 1}
    with pytest.raises(dq.DataQualityError):
        dq.assert_passing(dq.run_checks(df, "t", [dq.not_null("k")]))


def test_stream_matches_batch_on_landed_snapshots(spark):
    from tests.conftest import SF_SMALL
    from punctual.sources import fixtures as fx
    landing = os.path.join(_fresh(), "landing")
    pings = fx.pings(spark, SF_SMALL)
    snap.land_snapshots(snap.snapshot_documents(pings), landing)
    from punctual.streaming.positions import stream_positions
    out, ck = os.path.join(_fresh(), "out"), os.path.join(_fresh(), "ck")
    q = (stream_positions(spark, landing, max_files=1).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == pings.count()
    assert got.exceptAll(pings.select(*got.columns)).count() == 0
    assert got.select(F.countDistinct("vehicle_id")).first()[0] > 1


def test_stream_by_service_date_equals_batch(spark):
    from tests.conftest import SF_SMALL
    from punctual.config import PipelineConfig
    from punctual.plans import transit as T
    from punctual.sources import fixtures as fx
    from punctual.streaming.positions import (read_fact, remove_superseded, stream_incremental,
                                              stream_positions)
    from tests.helpers import rows
    cfg = PipelineConfig(by_service_date=True)
    inp = T.fixture_inputs(spark, SF_SMALL)
    landing = os.path.join(_fresh(), "landing")
    snap.land_snapshots(snap.snapshot_documents(fx.pings(spark, SF_SMALL)), landing)
    store, fact, ck = (os.path.join(_fresh(), n) for n in ("store", "fact", "ck"))
    q = stream_incremental(spark, stream_positions(spark, landing, max_files=1),
                           T.route_stops(inp, cfg), T.schedule(inp), store, fact, ck, cfg)
    q.awaitTermination()
    log = spark.read.parquet(f"{fact}/_log")
    assert log.select("version").distinct().count() >= 2          # several micro-batches
    # a batch writes again only the days it holds
    days = spark.read.parquet(store).select("epoch", "service_date").distinct()
    extra = log.join(days, (log.version == days.epoch + 1) & (log.day == days.service_date.cast("string")), "left_anti")
    assert extra.count() == 0
    got = read_fact(spark, fact).toPandas()
    assert remove_superseded(spark, fact) >= 0
    assert rows(read_fact(spark, fact).toPandas()) == rows(got)
    want = T.fact(inp, cfg).toPandas()
    assert len(want) > 100
    assert rows(got) == rows(want)


def test_batched_raw_load_and_union_by_name(spark):
    from tests.conftest import SF_SMALL
    from punctual.sources import fixtures as fx
    from punctual.streaming.positions import load_raw_snapshots
    landing = os.path.join(_fresh(), "landing")
    pings = fx.pings(spark, SF_SMALL)
    snap.land_snapshots(snap.snapshot_documents(pings).repartition(6), landing)
    raw, ck = os.path.join(_fresh(), "raw"), os.path.join(_fresh(), "ck")
    q = load_raw_snapshots(spark, landing, raw, ck, batch_files=2)
    q.awaitTermination()
    assert q.lastProgress is not None
    loaded = spark.read.parquet(raw)
    assert loaded.count() == pings.count()
    assert loaded.select(F.countDistinct("filename")).first()[0] >= 3
    a = spark.createDataFrame([("1", 1)], "k string, x int")
    b = spark.createDataFrame([(2.0, "2")], "y double, k string")
    u = {r.k: (r.x, r.y) for r in mat.union_batches([a, b]).collect()}
    assert u == {"1": (1, None), "2": (None, 2.0)}


def test_worst_routes_table_headers(spark):
    from punctual.operators.reliability import worst_routes_table
    f = spark.createDataFrame([("R1", 1.0), ("R1", 9.0)], "route_id string, delay_minutes double")
    t = worst_routes_table(f, min_n=1)
    assert t.columns == ["Route", "Arrivals", "Avg delay (min)", "On-time %"]
    assert t.collect()[0]["On-time %"] == 50.0


def test_large_polls_split_into_bounded_documents(spark):
    from tests.conftest import SF_SMALL
    from punctual.sources import fixtures as fx
    pings = fx.pings(spark, SF_SMALL)
    docs = snap.snapshot_documents(pings, document_entities=2)
    sizes = [r.n for r in docs.select(F.size("entity").alias("n")).collect()]
    assert max(sizes) <= 6 and sum(sizes) == pings.count()
    landing = os.path.join(_fresh(), "landing")
    snap.land_snapshots(docs, landing)
    raw = snap.read_snapshots(spark, landing)
    assert raw.count() == pings.count()


def test_stop_export_drops_missing_coordinates(spark):
    raw = spark.createDataFrame(
        [("1", "A", "43.6", "-79.4"), ("2", "B", None, "-79.4"), ("3", "C", "x", "-79.4"),
         ("4", "D", "43.7", "")], "stop_id string, stop_name string, stop_lat string, "
        "stop_lon string")
    out = os.path.join(_fresh(), "stops")
    mat.export_stop_coordinates(raw, out)
    got = [(r.stop_id, r.stop_lat, r.stop_lon) for r in spark.read.parquet(out).collect()]
    assert got == [("1", 43.6, -79.4)]


def test_csv_quotes_and_first_match(spark):
    from punctual.sources import gtfs
    d = _fresh()
    for sub_dir, name in (("b", "second"), ("a", 'Queen ""East"" St, Stop')):
        os.makedirs(os.path.join(d, sub_dir, "deep"))
        with open(os.path.join(d, sub_dir, "deep", "stops.txt"), "w") as fh:
            fh.write(f'stop_id,stop_name,stop_lat,stop_lon\n1,"{name}",43.6,-79.4\n')
    got = gtfs.read_gtfs(spark, d, "stops").collect()
    assert [tuple(r) for r in got] == [("1", 'Queen "East" St, Stop', "43.6", "-79.4")]
    assert gtfs.read_gtfs(spark, d, "routes") is None
    with pytest.raises(FileNotFoundError):
        gtfs.read_gtfs(spark, d, "routes", required=True)


def test_truncated_documents_are_not_lost_silently(spark):
    d = os.path.join(_fresh(), "x", "date=2024-01-01")
    os.makedirs(d)
    doc = json.dumps({"header": {"timestamp": "1704103230"}, "entity": [{"id": "e", "vehicle": {
        "vehicle": {"id": "V"}, "position": {"latitude": 43.7, "longitude": -79.3}, "timestamp": "1704103230"}}]})
    with open(os.path.join(d, "s.json"), "w") as fh:
        fh.write(doc + "\n" + doc[:60] + "\n")
    root = os.path.dirname(os.path.dirname(d))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        snap.read_snapshots(spark, root).collect()
    assert snap.read_snapshots(spark, root, failfast=False).select("date").collect()[0][0] == "2024-01-01"
    q = snap.document_quality(spark, root).first()
    assert (q.documents, q.corrupt_documents, q.entities) == (2, 1, 1)


def test_scd2_needs_a_unique_key(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b")], "k string, v string")
    with pytest.raises(mat.DuplicateKeyError):
        mat.scd2_snapshot(spark, df, os.path.join(_fresh(), "s"), ["k"], ["v"], "2024-01-01")


def test_only_a_missing_path_means_a_first_run(spark):
    path = os.path.join(_fresh(), "t")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as fh:
        fh.write("not parquet")
    df = _fact_rows(spark, [("a", ts("2024-01-01 10:00:00"), 1.0)])
    with pytest.raises(Exception):
        mat.append_incremental(spark, df, path)
    assert os.path.exists(os.path.join(path, "part-0.parquet"))


def test_all_failing_checks_are_named(spark):
    res = spark.createDataFrame([("m", f"c{i}", "not_null", 1) for i in range(30)],
                                "model string, column_name string, test string, violations long")
    with pytest.raises(dq.DataQualityError) as e:
        dq.assert_passing(res)
    assert all(f"c{i} " in str(e.value) for i in range(30))
