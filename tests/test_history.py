"""Change capture by row hashes: equal to a dictionary, only changed buckets written."""

from __future__ import annotations

import random
import tempfile
import threading

import pytest

from punctual.sinks.history import HistoryTable
from punctual.sinks.materialize import DuplicateKeyError
from punctual.sinks.tablelog import CommitConflict

SCHEMA = "a string, b int, x double, y string, note string"


def history(spark, rows_per_file=1_000_000):
    return HistoryTable(spark, tempfile.mkdtemp(prefix="punctual-test-") + "/h", ["a", "b"], ["x", "y"], rows_per_file)


def day(n):
    return f"2024-01-{n:02d} 00:00:00"


def state(t):
    return sorted([(r.a, r.b, r.x, r.y, r.valid_from.day, r.valid_to and r.valid_to.day) for r in t.read().collect()], key=repr)


def frame(spark, rows, note="n"):
    return spark.createDataFrame([(*k, *v, note) for k, v in rows.items()], SCHEMA)


@pytest.mark.parametrize("rows_per_file,hard", [(5, True), (1_000_000, False)])
def test_runs_equal_a_dictionary(spark, rows_per_file, hard):
    rng, t = random.Random(2), history(spark, rows_per_file)
    assert t.read() is None and t.read_open() is None
    open_rows, closed = {}, []
    source = {(rng.choice("pq"), i): (0.5, "s") for i in range(30)} | {(None, 1): (None, "s"), (None, None): (1.0, None), ("z", None): (None, None)}
    for run in range(1, 5):
        t.capture(frame(spark, source, f"note {run}"), day(run), hard)
        for k in [*open_rows]:
            if (k in source and open_rows[k][:2] != source[k]) or (hard and k not in source):
                closed.append((*k, *open_rows.pop(k), run))
        for k, v in source.items():
            open_rows.setdefault(k, (*v, run))
        assert state(t) == sorted([(*k, *v, None) for k, v in open_rows.items()] + closed, key=repr)
        assert t.read_open().count() == len(open_rows)
        for k in rng.sample(sorted(source, key=repr), 4):  # swapped nulls are changes, too
            source[k] = rng.choice([(None, "s"), (0.5, None), (rng.random(), "new")])
        del source[rng.choice(sorted(source, key=repr))]
        source[("new", run)] = (None, None)
    before = state(t)
    t.compact()
    assert state(t) == before
    if rows_per_file > 100:  # every commit is a small one
        assert [r["state"] for r in t.table.version().runs] == ["open", "closed"]


def test_unchanged_rows_are_not_written_again(spark):
    t = history(spark, rows_per_file=100)
    rows = {("k", i): (float(i), "s") for i in range(3200)}
    first = t.capture(frame(spark, rows), day(1))
    files = t.table.files(t.table.version()).count()
    assert files >= 32
    assert t.capture(frame(spark, rows, "columns that aren't checked"), day(2)) == first  # nothing to commit
    for i in (5, 6, 7):
        rows[("k", i)] = (-1.0, "s")
    t.capture(frame(spark, rows), day(3))
    v = t.table.version()
    assert sum(len(r["without"]) for r in v.runs) <= 3  # files of three changed keys
    assert sum(r["rows"] for r in v.runs if r["state"] == "closed") == 3
    assert sum(r["rows"] for r in v.runs if r["state"] == "open" and not r["without"]) <= 3 * 200


def test_replays_duplicates_and_empty_sources(spark):
    t = history(spark)
    empty = frame(spark, {})
    t.capture(empty, day(1))
    assert t.read().count() == 0
    one = frame(spark, {("k", 1): (1.0, "s")})
    v = t.capture(one, day(2), txn=("load", 1))
    assert t.capture(frame(spark, {("k", 1): (2.0, "s")}), day(3), txn=("load", 1)) == v
    assert state(t) == [("k", 1, 1.0, "s", 2, None)]
    with pytest.raises(DuplicateKeyError):
        t.capture(one.union(one), day(3))
    t.capture(empty, day(4))
    assert state(t) == [("k", 1, 1.0, "s", 2, None)]
    t.capture(empty, day(5), invalidate_hard_deletes=True)
    assert state(t) == [("k", 1, 1.0, "s", 2, 5)]


def test_two_runs_at_the_same_time(spark):
    t = history(spark)
    t.capture(frame(spark, {("k", i): (0.0, "s") for i in range(20)}), day(1))
    failed = []

    def run(i):
        try:
            t.capture(frame(spark, {("k", j): (1.0 if j % 2 == i else 0.0, "s") for j in range(20) if j % 2 == i}), day(2))
        except CommitConflict as e:
            failed.append(e)
    threads = [threading.Thread(target=run, args=(i,)) for i in range(2)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert not failed and t.read_open().where("x = 1.0").count() == 20 and t.read().count() == 40
