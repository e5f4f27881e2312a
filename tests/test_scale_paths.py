"""The physical alternatives chosen for scale give the same results as the
default plan: salted as-of buckets, shuffle-join fallback beyond the
broadcast bound, route-only join vs grid join, headway chunk size."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctual.config import PipelineConfig, ScaleConfig
from punctual.operators import headways as hwo
from punctual.plans import transit as T
from tests.conftest import SF_SMALL
from tests.helpers import rows


def _fact(spark, cfg):
    return T.fact(T.fixture_inputs(spark, SF_SMALL), cfg).toPandas()


def test_salted_asof_equals_default(spark):
    base = _fact(spark, PipelineConfig())
    salted = _fact(spark, PipelineConfig(scale=ScaleConfig(asof_skew_rows=2)))
    assert len(base) > 100
    assert rows(salted) == rows(base)


def test_narrow_buckets_equal_default(spark):
    base = _fact(spark, PipelineConfig())
    narrow = _fact(spark, PipelineConfig(scale=ScaleConfig(asof_bucket_s=3600)))
    assert rows(narrow) == rows(base)


def test_shuffle_join_beyond_broadcast_bound(spark):
    base = _fact(spark, PipelineConfig())
    shuffled = _fact(spark, PipelineConfig(scale=ScaleConfig(broadcast_max_bytes=0)))
    assert rows(shuffled) == rows(base)


def test_grid_join_equals_route_join(spark):
    from punctual.operators import arrivals as arr
    inp = T.fixture_inputs(spark, SF_SMALL)
    rs = T.route_stops(inp, PipelineConfig())
    from punctual.functions.geo import planar_distance_m
    cfg = PipelineConfig()
    grid = arr.proximity_join(inp.pings, rs, cfg).toPandas()
    # every ping of a route against every stop of it (small tables only)
    d = planar_distance_m(F.col("latitude"), F.col("longitude"), F.col("stop_latitude"),
                          F.col("stop_longitude"), cfg.m_lat, cfg.m_lon)
    plain = (inp.pings.join(rs, "route_id").withColumn("distance_m", d).where("distance_m <= 50")
             .select(*arr.CANDIDATE_COLS).toPandas())
    assert len(grid) > 100
    assert rows(grid) == rows(plain)


def test_headway_chunks_equal(spark):
    f = T.fact(T.fixture_inputs(spark, SF_SMALL), PipelineConfig())
    day = hwo.headways(f, chunk_s=86_400).toPandas()
    hour = hwo.headways(f, chunk_s=3_600).toPandas()
    assert len(day) > 50
    assert rows(hour) == rows(day)


def test_target_route_filters_everything(spark):
    inp = T.fixture_inputs(spark, SF_SMALL)
    full = T.fact(inp, PipelineConfig()).where("route_id = '102'").toPandas()
    one = T.fact(inp, PipelineConfig(target_route="102")).toPandas()
    assert rows(one) == rows(full)


def test_restricted_incremental_equals_full_rebuild_append(spark):
    import os
    import tempfile

    from punctual.sinks.materialize import append_incremental
    inp = T.fixture_inputs(spark, SF_SMALL)
    cut = inp.pings.select(F.percentile(F.unix_seconds("recorded_at"), 0.6)).first()[0]
    early = T.Inputs(inp.stops, inp.trips, inp.stop_times, inp.routes,
                     inp.pings.where(F.unix_seconds("recorded_at") < F.lit(cut)))
    for cfg in (PipelineConfig(), PipelineConfig(by_service_date=True)):
        a, b = (os.path.join(tempfile.mkdtemp(prefix="punctual-test-"), "f") for _ in "ab")
        T.incremental_fact(spark, early, a, cfg)
        T.incremental_fact(spark, inp, a, cfg)
        append_incremental(spark, T.fact(early, cfg), b)
        append_incremental(spark, T.fact(inp, cfg), b)
        got, want = spark.read.parquet(a).toPandas(), spark.read.parquet(b).toPandas()
        assert len(want) > 100
        assert rows(got) == rows(want)


def test_nearest_gap_over_a_repeated_timetable(spark):
    from punctual.operators import profiling as prof
    inp = T.fixture_inputs(spark, SF_SMALL)
    a = T.arrivals(inp, PipelineConfig())
    base = prof.nearest_gap(a, inp.stop_times, inp.trips, "102").first()[0]
    # the timetable ten times over changes neither the result nor what meets in a bucket
    many = inp.stop_times
    for _ in range(9):
        many = many.unionByName(inp.stop_times)
    again = prof.nearest_gap(a, many, inp.trips, "102").first()[0]
    assert base is not None and again == base


def test_timetable_points_do_not_grow_with_trips(spark):
    from punctual.operators import schedule as sch
    inp = T.fixture_inputs(spark, SF_SMALL)
    one = T.schedule(inp)
    ten = one
    for _ in range(9):
        ten = ten.unionByName(one)

    def largest(s):
        points = sch._schedule_points(s, PipelineConfig())
        return points.groupBy("route_id", "stop_id").count().agg(F.max("count")).first()[0]
    assert largest(ten) == largest(one)
