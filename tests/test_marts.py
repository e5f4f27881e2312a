"""Incremental mart: equal to a full build after appends, replaced and removed rows."""

from __future__ import annotations

import datetime as dt
import random
import tempfile

from punctual.operators.reliability import route_reliability
from punctual.plans.marts import DailyMart
from punctual.sinks.tablelog import LogTable

SCHEMA = "k long, route_id string, stop_name string, direction_id int, delay_minutes double, actual_arrival timestamp"


def rows(rng, keys, day):
    at = None if day is None else dt.datetime(2024, 1, day, 5)
    return [(k, rng.choice(["1", "2", None]), rng.choice("ab"), rng.choice([0, 1, None]), round(rng.uniform(-30, 30), 1),
             at and at + dt.timedelta(minutes=rng.randrange(600))) for k in keys]


def same(mart, facts):
    want = sorted(map(tuple, route_reliability(facts.read()).collect()), key=repr)
    assert sorted(map(tuple, mart.read().collect()), key=repr) == want
    return want


def number(day):
    return (dt.date(2024, 1, day) - dt.date(1970, 1, 1)).days


def test_appends_and_a_replaced_day(spark):
    rng, folder = random.Random(3), tempfile.mkdtemp(prefix="punctual-test-")
    facts = LogTable(spark, f"{folder}/f", ["k"], ["actual_arrival"], rows_per_file=50)
    mart = DailyMart(spark, f"{folder}/m", facts)
    assert mart.read() is None
    put = lambda r, **kw: facts.upsert(spark.createDataFrame(r, SCHEMA), **kw)
    for i in range(3):
        put(rows(rng, range(i * 60, i * 60 + 60), i + 1))
        assert mart.refresh() == (None if i == 0 else [number(i + 1)])
        same(mart, facts)
    read = mart.rows_of(facts.version(), [number(2)])
    assert read.count() == 60 and len(read.inputFiles()) < facts.files(facts.version()).count()
    put(rows(rng, range(60, 120), 2))  # the second day anew
    assert mart.refresh() == [number(2)]
    same(mart, facts)
    put(rows(rng, [5], 3))  # a row moves from the first to the third day
    assert mart.refresh() == [number(1), number(3)]
    facts.compact()  # rows move between files only
    assert mart.refresh() == [] and mart.refresh() == []
    put(rows(rng, range(200, 205), None))  # without a time
    assert mart.refresh() == [None]
    same(mart, facts)
    put([], deletes=facts.read().where("k BETWEEN 60 AND 119").select("k"))  # a day goes
    assert mart.refresh() == [number(2)]
    same(mart, facts)
    assert mart.state.read().where(f"day = {number(2)}").count() == 0
