"""Findings of round 3: empty means, joins dealt once by trip, one-pass histories."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest

import __spark_entry__ as E
from punctual.sources import fixtures as fx


def write_tables(spark, events, orders=((1, 5), (2, 6)), items=((1, 1, 1, 1, "N"), (2, 2, 1, 2, "A"))):
    """The driver tables that the transit views read, with few rows; the folder."""
    d = tempfile.mkdtemp(prefix="punctual-test-")
    for name, rows, schema in (
            ("region", [(i, f"R{i}") for i in range(5)], "r_regionkey long, r_name string"),
            ("nation", [(i, f"N{i}", i % 5) for i in range(25)], "n_nationkey long, n_name string, n_regionkey long"),
            ("orders", [(k, c, "1-URGENT", "O") for k, c in orders], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string"),
            ("lineitem", list(items), "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"),
            ("events", events, "event_id long, user_id long, event_type string, ts timestamp")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("name", ["route_bunching_limit", "route_summary_limit"])
def test_no_row_has_no_mean(spark, name):
    events = [(i, 1, "view", dt.datetime(2024, 1, 1, 0, 0, i)) for i in range(3)]
    assert E.queries()[name](spark, write_tables(spark, events)).collect() == []


def exchanges(df) -> int:
    """Shuffles of the plan as it is before any of them has run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_timetable_is_dealt_once_by_trip(spark, no_broadcast):
    d = write_tables(spark, [(1, 1, "view", dt.datetime(2024, 1, 1))])
    timetable = fx.stop_times(spark, d).join(fx.trips(spark, d), "trip_id")
    assert exchanges(timetable) == 3  # line items, and orders for each of the two joins


def test_a_snapshot_run_deals_its_source_once(spark, no_broadcast):
    from pyspark.sql import functions as F

    from punctual.sinks import materialize as mat

    rows = [(None, 1, "a"), ("x", None, "b"), (None, None, None), ("y", 2, "c")]
    schema = "k1 string, k2 int, v string"
    source = spark.createDataFrame(rows, schema)
    path = tempfile.mkdtemp(prefix="punctual-test-") + "/s"
    mat.scd2_snapshot(spark, source, path, ["k1", "k2"], ["v"], "2024-01-01")
    hist = spark.read.parquet(f"{path}/{mat.runs_of(spark, path)[-1]}").where("state = 'open'").drop("state")
    run = mat._scd2_rows(source, hist, ["k1", "k2"], ["v"], F.lit("2024-01-02").cast("timestamp"), False)
    assert exchanges(run) == 2  # the source and the open rows: nothing more to count keys
    for again in (source.union(source.where("k1 IS NULL AND k2 IS NULL")), source.union(source.where("k1 = 'y'"))):
        with pytest.raises(mat.DuplicateKeyError, match="not unique"):
            mat.scd2_snapshot(spark, again, path, ["k1", "k2"], ["v"], "2024-01-02")
    mat.scd2_snapshot(spark, spark.createDataFrame([(None, 1, None), ("x", None, "b")], schema), path, ["k1", "k2"], ["v"], "2024-01-03")
    got = sorted(((r.k1, r.k2, r.v, r.valid_to and r.valid_to.day) for r in mat.read_scd2(spark, path).collect()), key=repr)
    assert got == sorted([*[(*r, None) for r in rows[1:]], (None, 1, "a", 3), (None, 1, None, None)], key=repr)


def test_the_first_round_sums_paths_once_for_all_languages(monkeypatch):
    import numpy as np

    from punctual.llm import language_id as L

    pieces = ["▁", "a", "ab", "b", "▁a"]
    lattice = L.Pieces(pieces).lattice(["▁abab", "▁bbab", "▁xabb"])
    weight = np.array([[1.0, 0, 2], [3, 0, 0], [0, 0, 5]])
    prob = np.full((len(pieces) + 1, 3), 1 / (len(pieces) + 1))
    whole = np.zeros_like(prob)
    for k in range(3):  # each language alone
        one = np.zeros((len(prob), 1))
        L.expected(lattice, prob[:, [k]], weight[:, [k]], one)
        whole[:, k] = one[:, 0]
    widths, sum_paths = [], L.sum_paths
    monkeypatch.setattr(L, "sum_paths", lambda *a: widths.append(a[5].shape[1]) or sum_paths(*a))
    out = np.zeros_like(prob)
    L.expected(lattice, prob, weight, out)
    assert widths == [1, 1] and (out == whole).all()
