"""The merged arrival state equals a full rebuild after every batch, whatever
order pings come in, and reads no more as the stream grows older."""

from __future__ import annotations

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from punctual.config import PipelineConfig
from punctual.plans import transit as T
from punctual.sinks import tablelog
from punctual.streaming import arrival_state as st
from tests.helpers import inputs, north, rows

T0 = dt.datetime(2024, 1, 1, 8)
STOPS = [(f"s{i}", f"Stop {i}", north(43.6, 60.0 * i), -79.4) for i in range(4)]
TRIPS = [("T1", "R", "s", "h", 0), ("T2", "R", "s", "h", 1), ("T3", "Q", "s", "h", 0)]
TIMES = [(t, f"s{i}", i, f"08:{10 * i:02d}:00") for t in ("T1", "T2", "T3") for i in range(4)]


def fixture(spark, pings):
    return inputs(spark, STOPS, TRIPS, TIMES, pings)


def random_pings(rng, n):
    out = []
    for _ in range(n):
        # few vehicles and times: told again elsewhere, shared by trips, late
        out.append((rng.choice(["R", "Q", None]), rng.choice(["T1", "T2", "T3", None]), rng.choice(["v1", "v2", None]),
                    north(43.6, rng.uniform(-60, 240)), -79.4, T0 + dt.timedelta(minutes=rng.choice([0, 1, 2, 3, 61, 62, 1500]))))
    return out


def apply(spark, pings, epoch, store, fact_path):
    inp = fixture(spark, pings)
    cfg = PipelineConfig()
    st.update_state(spark, inp.pings, epoch, store, fact_path, T.route_stops(inp, cfg), T.schedule(inp), cfg)


def test_every_batch_equals_a_full_rebuild(spark):
    rng, seen = random.Random(1), []
    store, fact_path = (tempfile.mkdtemp(prefix="punctual-test-") + "/t" for _ in "ab")
    for epoch in range(3):
        batch = random_pings(rng, 14)
        seen += batch
        apply(spark, batch, epoch, store, fact_path)
        inp = fixture(spark, seen)
        want = T.fact(inp, PipelineConfig()).toPandas()
        assert rows(st.fact_table(spark, fact_path).read().toPandas()) == rows(want) and len(want)
        assert rows(st.arrival_table(spark, store).read().toPandas()) == rows(T.arrivals(inp, PipelineConfig()).select(*st.ARRIVAL, "actual_arrival", "closest_distance_m").toPandas())
    apply(spark, batch, 2, store, fact_path)  # a replay
    assert rows(st.fact_table(spark, fact_path).read().toPandas()) == rows(want)


def test_a_batch_that_dies_is_replayed(spark, monkeypatch):
    rng = random.Random(7)
    store, fact_path = (tempfile.mkdtemp(prefix="punctual-test-") + "/t" for _ in "ab")
    one, two = random_pings(rng, 20), random_pings(rng, 20)
    apply(spark, one, 0, store, fact_path)
    real = tablelog.LogTable.upsert

    def die(self, *a, **k):  # after the fact, before the arrivals
        if self.key == st.ARRIVAL:
            raise RuntimeError("lost")
        return real(self, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(tablelog.LogTable, "upsert", die)
        with pytest.raises(RuntimeError):
            apply(spark, two, 1, store, fact_path)
    apply(spark, two, 1, store, fact_path)
    want = T.fact(fixture(spark, one + two), PipelineConfig()).toPandas()
    assert rows(st.fact_table(spark, fact_path).read().toPandas()) == rows(want)


def test_batches_read_no_more_as_the_stream_grows(spark, monkeypatch):
    """Eight equal batches, an hour each: pings read and files of arrivals and fact
    read stay flat."""
    store, fact_path = (tempfile.mkdtemp(prefix="punctual-test-") + "/t" for _ in "ab")
    read, sizes = [], []
    load, pings = tablelog.LogTable._load, st._pings

    def loaded(self, files, schema):
        read.append(len(files))
        return load(self, files, schema)

    def told(*a):
        df = pings(*a)
        read.append(df.count())
        return df

    monkeypatch.setattr(tablelog.LogTable, "_load", loaded)
    monkeypatch.setattr(st, "_pings", told)
    for epoch in range(8):
        batch = [("R", "T1" if epoch % 2 else f"X{epoch}", f"v{k}", north(43.6, 60.0 * i), -79.4, T0 + dt.timedelta(hours=epoch, minutes=2 * i))
                 for k in range(3) for i in range(4)]
        read.clear()
        apply(spark, batch, epoch, store, fact_path)
        sizes.append(sum(read))
    assert max(sizes[4:]) <= max(sizes[:4])
    assert st.arrival_table(spark, store).read().count() == 60
