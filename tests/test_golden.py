"""Hand-computed cases for the edge semantics of the model."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.config import PipelineConfig
from punctual.operators import arrivals as arr
from punctual.operators import headways as hwo
from punctual.operators import panels as pn
from punctual.operators import reliability as rel
from punctual.operators import schedule as sch
from punctual.plans import transit as TR
from tests.helpers import inputs, north, ts

LAT, LON = 43.6, -79.4
CFG = PipelineConfig()


def _stops():
    return [("S1", "First", LAT, LON),
            ("S2", "Second", north(LAT, 100), LON),
            ("S4", "Twin B", north(LAT, 300), LON),
            ("S3", "Twin A", north(LAT, 300), LON)]


def _trips():
    return [("T1", "R1", "wk", "north", 0)]


def _stop_times():
    return [("T1", "S1", 1, "10:00:00"), ("T1", "S2", 2, "10:05:00"),
            ("T1", "S3", 3, "10:10:00"), ("T1", "S4", 4, "10:10:00")]


def test_radius_is_inclusive_and_nearest_wins(spark):
    pings = [
        ("R1", "T1", "V1", north(LAT, 49.99), LON, ts("2024-01-01 10:00:00")),   # S1 at 49.99 m
        ("R1", "T1", "V1", north(LAT, 50.01), LON, ts("2024-01-01 10:00:30")),   # 49.99 m from S2
        ("R1", "T1", "V2", north(LAT, 150.5), LON, ts("2024-01-01 10:01:00")),   # 50.5 m: none
        ("R1", "T1", "V3", north(LAT, 300), LON, ts("2024-01-01 10:02:00")),     # twins: S3
        (None, "T1", "V4", LAT, LON, ts("2024-01-01 10:03:00")),                 # no route
    ]
    inp = inputs(spark, _stops(), _trips(), _stop_times(), pings)
    got = {(r.vehicle_id, r.recorded_at.strftime("%H:%M:%S")): r.stop_id
           for r in TR.nearest(inp, CFG).collect()}
    assert got == {("V1", "10:00:00"): "S1", ("V1", "10:00:30"): "S2",
                   ("V3", "10:02:00"): "S3"}


def test_first_arrival_repeated_pings_and_null_trip(spark):
    t = ts("2024-01-01 10:00:00")
    pings = [("R1", None, "V1", LAT, LON, t),
             ("R1", None, "V1", LAT, LON, t),                       # exact duplicate
             ("R1", None, "V1", north(LAT, 10), LON, t + dt.timedelta(seconds=30))]
    inp = inputs(spark, _stops(), _trips(), _stop_times(), pings)
    out = TR.arrivals(inp, CFG).collect()
    assert len(out) == 1
    r = out[0]
    assert r.trip_id is None and r.stop_id == "S1" and r.actual_arrival == t
    assert r.closest_distance_m == 0.0


def _arrivals(spark, rows):
    schema = T.StructType([T.StructField("vehicle_id", T.StringType()),
                           T.StructField("route_id", T.StringType()),
                           T.StructField("trip_id", T.StringType()),
                           T.StructField("stop_id", T.StringType()),
                           T.StructField("stop_name", T.StringType()),
                           T.StructField("actual_arrival", T.TimestampType())])
    return spark.createDataFrame(rows, schema)


def _schedule(spark, rows):
    schema = "route_id string, stop_id string, scheduled_arrival_str string, direction_id int"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("sched_secs", F.expr(
        "cast(split_part(scheduled_arrival_str, ':', 1) as int) * 3600 + "
        "cast(split_part(scheduled_arrival_str, ':', 2) as int) * 60 + "
        "cast(split_part(scheduled_arrival_str, ':', 3) as int)"))


def _match(spark, arrivals, schedule, cfg=CFG):
    f = sch.stop_performance(sch.match_schedule(_arrivals(spark, arrivals),
                                                _schedule(spark, schedule), cfg))
    return {r.vehicle_id: (r.scheduled_arrival_str, r.direction_id, r.delay_seconds,
                           r.delay_minutes) for r in f.collect()}


def test_nearest_schedule_ties_window_and_midnight(spark):
    arrivals = [("A", "R", "t", "S1", "n", ts("2024-01-01 10:00:00")),   # 09:55 vs 10:05
                ("B", "R", "t", "S2", "n", ts("2024-01-01 11:00:00")),   # 1800 s: kept
                ("C", "R", "t", "S3", "n", ts("2024-01-01 11:00:00")),   # 1801 s: dropped
                ("D", "R", "t", "S4", "n", ts("2024-01-02 00:30:00")),   # vs 24:30:00
                ("E", "R", "t", "S5", "n", ts("2024-01-01 12:00:00"))]   # direction tie
    schedule = [("R", "S1", "09:55:00", 0), ("R", "S1", "10:05:00", 0),
                ("R", "S2", "10:30:00", 1),
                ("R", "S3", "10:29:59", 1),
                ("R", "S4", "24:30:00", 0),
                ("R", "S5", "12:00:00", 1), ("R", "S5", "12:00:00", None),
                ("R", "S5", "12:00:00", 0)]
    got = _match(spark, arrivals, schedule)
    assert got == {"A": ("09:55:00", 0, 300, 5.0), "B": ("10:30:00", 1, 1800, 30.0),
                   "E": ("12:00:00", None, 0, 0.0)}
    wrapped = _match(spark, arrivals, schedule, PipelineConfig(wrap_midnight=True))
    assert wrapped["D"] == ("24:30:00", 0, 0, 0.0)


def test_delay_minutes_round_half_away_from_zero(spark):
    arrivals = [(v, "R", "t", "S1", "n", ts(f"2024-01-01 10:00:{s:02d}"))
                for v, s in [("p3", 3), ("p9", 9), ("p1", 1)]]
    arrivals += [("m3", "R", "t", "S2", "n", ts("2024-01-01 09:59:57")),
                 ("m1", "R", "t", "S2", "n", ts("2024-01-01 09:59:59"))]
    schedule = [("R", "S1", "10:00:00", 0), ("R", "S2", "10:00:00", 0)]
    got = {k: v[3] for k, v in _match(spark, arrivals, schedule).items()}
    assert got == {"p3": 0.1, "p9": 0.2, "p1": 0.0, "m3": -0.1, "m1": 0.0}
    assert str(got["m1"]) == "0.0"          # never -0.0


def _fact(spark, rows):
    schema = ("trip_stop_id string, vehicle_id string, route_id string, stop_id string, "
              "stop_name string, actual_arrival timestamp, scheduled_arrival_str string, "
              "direction_id int, delay_seconds bigint, delay_minutes double")
    return spark.createDataFrame(rows, schema)


def test_on_time_flag_and_state_disagree_at_minus_one(spark):
    f = _fact(spark, [("k1", "v", "R", "S", "n", ts("2024-01-01 10:00:00"), "x", 0, -60, -1.0),
                      ("k2", "v", "R", "S", "n", ts("2024-01-01 10:00:00"), "x", 0, 300, 5.0),
                      ("k3", "v", "R", "S", "n", ts("2024-01-01 10:00:00"), "x", 0, 306, 5.1)])
    got = {r.trip_stop_id: (r.is_on_time, r.state)
           for r in pn.with_delay_state(f).collect()}
    assert got == {"k1": (1, "Early"), "k2": (1, "On time"), "k3": (0, "Late")}
    m = rel.route_reliability(f).collect()[0]
    assert (m.total_arrivals, m.on_time_count, m.on_time_pct) == (3, 2, 66.7)
    assert m.avg_delay_min == 3.03          # (-1.0 + 5.0 + 5.1) / 3 = 3.0333


def test_headway_band_median_and_null_keys(spark):
    base = dt.datetime(2024, 1, 1, 6, 0, 0)
    minutes = [0, 0, 1, 91, 182]     # gaps 0 (peer), 1, 90, 91
    rows = [(f"k{i}", f"v{i}", "R", "S", "n", base + dt.timedelta(minutes=m), "x", 0, 0, 0.0)
            for i, m in enumerate(minutes)]
    rows.append(("solo", "v", "R", "S9", "n", base, "x", 0, 0, 0.0))
    rows.append(("nodir", "v", "R", "S", "n", base, "x", None, 0, 0.0))
    f = _fact(spark, rows)
    for chunk in (86_400, 3_600):
        hw = hwo.headways(f, chunk_s=chunk)
        got = sorted((r.trip_stop_id, r.headway_min, r.hw_median, r.bunched, r.gapped)
                     for r in hw.collect())
        assert got == [("k2", 1.0, 45.5, True, False), ("k3", 90.0, 45.5, False, True)]


def test_rounding_helpers_are_exact(spark):
    from fractions import Fraction

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from punctual.functions.rounding import round_ratio

    def exact(num, den, digits, half_even):
        q = Fraction(num, den) * 10 ** digits
        sgn = -1 if q < 0 else 1
        q = abs(q)
        fl = q.numerator // q.denominator
        rem = q - fl
        up = rem > Fraction(1, 2) or (rem == Fraction(1, 2) and (not half_even or fl % 2 == 1))
        return sgn * (fl + (1 if up else 0)) / 10 ** digits

    cases = []

    @settings(max_examples=200, deadline=None)
    @given(st.integers(-10**9, 10**9), st.integers(1, 10**6), st.integers(0, 3), st.booleans())
    def collect(num, den, digits, half_even):
        cases.append((num, den, digits, half_even))

    collect()
    cases += [(5, 2, 0, True), (15, 2, 0, True), (-5, 2, 0, False), (1005, 1000, 2, False)]
    df = spark.createDataFrame(cases, "num long, den long, digits int, he boolean")
    out = df.select("num", "den", "digits", "he", *[
        round_ratio(F.col("num"), F.col("den"), d, h).alias(f"r{d}{int(h)}")
        for d in range(4) for h in (False, True)]).collect()
    for r in out:
        want = exact(r.num, r.den, r.digits, r.he)
        assert r[f"r{r.digits}{int(r.he)}"] == pytest.approx(want, abs=0), (r, want)


def test_agency_time_zone_shifts_second_of_day(spark):
    arrivals = [("A", "R", "t", "S1", "n", ts("2024-01-15 15:02:00"))]   # 10:02 in Toronto (EST)
    schedule = [("R", "S1", "10:00:00", 0), ("R", "S1", "15:00:00", 0)]
    assert _match(spark, arrivals, schedule)["A"][0] == "15:00:00"
    tz = PipelineConfig(agency_tz="America/Toronto")
    assert _match(spark, arrivals, schedule, tz)["A"] == ("10:00:00", 0, 120, 2.0)


def test_empty_view_gives_empty_or_null_results(spark):
    f = _fact(spark, [("k1", "v", "R1", "S", "n", ts("2024-01-01 03:00:00"), "x", 0, 0, 0.0)])
    k = pn.filtered_kpis(f, route="nope", hours=(6, 20)).collect()[0]
    assert k.n == 0 and k.on_time_pct is None and k.avg_delay is None
    r = rel.route_kpis(f, "nope").collect()[0]
    assert (r.r_total, r.r_on_time, r.r_avg) == (0, 0.0, 0.0)
    assert pn.on_time_by_hour(f, hours=(6, 20)).count() == 0
    assert hwo.headway_stats(hwo.headways(f)).collect()[0].n == 0


def test_publish_fact_partitions_by_route(spark):
    import os
    import tempfile
    from punctual.sinks.materialize import publish_fact
    rows = [(f"k{i}", "v", f"R{i % 3}", "S", "n", ts("2024-01-01 10:00:00"), "x", 0, 0, 0.0)
            for i in range(30)]
    out = os.path.join(tempfile.mkdtemp(prefix="punctual-test-"), "serving")
    publish_fact(_fact(spark, rows), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("route_id=")) == \
        ["route_id=R0", "route_id=R1", "route_id=R2"]
    back = spark.read.parquet(out).where("route_id = 'R1'")
    assert back.count() == 10
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "R1" in plan.split("PartitionFilters", 1)[1][:200]


def test_unparseable_schedule_times_never_match(spark):
    arrivals = [("A", "R", "t", "S1", "n", ts("2024-01-01 10:00:00")),
                ("B", "R", "t", "S2", "n", ts("2024-01-01 10:00:00"))]
    schedule = [("R", "S1", "bad", 0), ("R", "S1", "10:01:00", 1),
                ("R", "S2", "10:xx:00", 0), ("R", "S2", "", 0)]
    schema = "route_id string, stop_id string, scheduled_arrival_str string, direction_id int"
    from punctual.functions.timefns import hms_to_seconds
    sched = spark.createDataFrame(schedule, schema).withColumn(
        "sched_secs", hms_to_seconds(F.col("scheduled_arrival_str")))
    f = sch.stop_performance(sch.match_schedule(_arrivals(spark, arrivals), sched, CFG))
    got = {r.vehicle_id: (r.scheduled_arrival_str, r.delay_seconds) for r in f.collect()}
    assert got == {"A": ("10:01:00", -60)}


def test_span_days_counts_whole_24h_periods(spark):
    f = _fact(spark, [("a", "v", "R", "S1", "n", ts("2024-01-01 23:00:00"), "x", 0, 0, 0.0),
                      ("b", "v", "R", "S2", "n", ts("2024-01-02 22:59:59"), "x", 0, 0, 0.0)])
    r = pn.scale_stats(f).collect()[0]
    assert (r.total_arrivals, r.total_routes, r.total_stops, r.span_days) == (2, 1, 2, 1)
    g = f.unionByName(_fact(spark, [("c", "v", "R2", "S1", "n", ts("2024-01-02 23:00:00"),
                                     "x", 0, 0, 0.0)]))
    assert pn.scale_stats(g).collect()[0].span_days == 2


def test_delay_histograms_round_half_even_and_clip(spark):
    d = [2.5, 3.5, -0.4, -2.5, 20.0, -16.6, 0.5]
    f = _fact(spark, [(f"k{i}", "v", "R", "S", "n", ts("2024-01-01 10:00:00"), "x", 0, 0, x)
                      for i, x in enumerate(d)])
    got = {r.delay_bucket: r.arrivals for r in pn.delay_histogram(f).collect()}
    assert got == {2.0: 1, 4.0: 1, 0.0: 2, -2.0: 1, 20.0: 1, -17.0: 1}
    clipped = {r.delay_bucket: r.arrivals
               for r in pn.clipped_delay_histogram(f, hours=(6, 20)).collect()}
    assert clipped == {2.0: 1, 4.0: 1, 0.0: 2, -2.0: 1, 15.0: 1, -15.0: 1}
    assert all(str(k) != "-0.0" for k in got)


def test_worst_stops_sort_on_unrounded_share(spark):
    def rows_for(name, n, on_time):
        return [(f"{name}{i}", "v", "R", "S", name, ts("2024-01-01 10:00:00"), "x", 0, 0,
                 0.0 if i < on_time else 9.0) for i in range(n)]
    # 2/3 = 66.67 % and 667/1000 = 66.7 %: equal after rounding, ordered before it
    f = _fact(spark, rows_for("A", 1000, 667) + rows_for("B", 3, 2) + rows_for("C", 3, 0)
              + rows_for("D", 2, 0))                      # D: below the 3-arrival minimum
    got = [(r.stop_name, r.arrivals, r.on_time_pct) for r in rel.worst_stops_view(f).collect()]
    assert got == [("C", 3, 0.0), ("B", 3, 66.7), ("A", 1000, 66.7)]
