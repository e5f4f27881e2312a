"""Atomic commits, key-located upserts, replays, concurrent and killed writers."""

from __future__ import annotations

import random
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from punctual.sinks import tablelog
from punctual.sinks.tablelog import LogTable, create_if_absent

SCHEMA = "a string, b int, day int, x long"


def table(spark, rows_per_file=1_000_000):
    return LogTable(spark, tempfile.mkdtemp(prefix="punctual-test-") + "/t", ["a", "b"], ["day"], rows_per_file)


def state(t):
    return sorted(map(tuple, t.read().collect()), key=repr)


def test_create_if_absent_is_won_once(spark):
    path = tempfile.mkdtemp(prefix="punctual-test-") + "/_log/1.json"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if create_if_absent(spark, path, f"writer {i}") else None) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and tablelog._read(spark, path) == f"writer {won[0]}"
    assert tablelog._names(spark, path.rsplit("/", 1)[0]) == ["1.json"]  # no writer left its own file


@pytest.mark.parametrize("rows_per_file", [7, 1_000_000])
def test_upserts_equal_a_dictionary(spark, rows_per_file):
    rng, want, t = random.Random(1), {}, table(spark, rows_per_file)
    assert t.read() is None and t.lookup(spark.createDataFrame([], SCHEMA)) is None
    for batch in range(4):
        rows = {(rng.choice(["p", "q", None, "long key"]), rng.choice([None, *range(12)])): (batch, rng.randrange(99)) for _ in range(25)}
        gone = [k for k in want if rng.random() < 0.1 and k not in rows]
        df = spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)
        t.upsert(df, deletes=spark.createDataFrame(gone, "a string, b int"))
        want = {k: v for k, v in want.items() if k not in gone} | rows
        assert state(t) == sorted(((*k, *v) for k, v in want.items()), key=repr)
    keys = spark.createDataFrame([*list(want)[:5], ("absent", 1)], "a string, b int")
    assert sorted(map(tuple, t.lookup(keys).collect()), key=repr) == sorted(((*k, *want[k]) for k in list(want)[:5]), key=repr)
    late = t.read(between={"day": (2, 3)})
    assert sorted(map(tuple, late.collect()), key=repr) == sorted(((*k, *v) for k, v in want.items() if v[0] >= 2), key=repr)
    before = state(t)
    t.compact(small=10 ** 9)
    assert state(t) == before and len(t.version().runs) == 1
    assert t.read(1).count() <= 25  # older versions stay readable
    assert t.remove_orphans(older_than_s=0, keep_versions=1) > 0 and state(t) == before


def test_only_files_that_hold_a_key_are_rewritten(spark):
    t = table(spark, rows_per_file=500)
    t.upsert(spark.range(8000).select(F.lit("k").alias("a"), F.col("id").cast("int").alias("b"), (F.col("id") % 10).cast("int").alias("day"), F.col("id").alias("x")))
    first = t.version()
    files = first.runs[0]["files"]
    assert files >= 8
    t.upsert(spark.createDataFrame([("k", 5, 99, -1), ("k", 7_000_000, 99, -2)], SCHEMA))
    second = t.version()
    assert len(second.runs[0]["without"]) == 1 and second.runs[1]["rows"] < 8000 / files * 3
    new = spark.range(10_000, 10_400).select(F.lit("k").alias("a"), F.col("id").cast("int").alias("b"))
    assert t.locate(new, second) == []  # unseen keys touch no file
    assert t.read().count() == 8001 and t.read().where("b = 5").first().day == 99
    assert t.greatest("day") == 99


def test_false_alarms_of_the_filter_are_few(spark):
    t = table(spark, rows_per_file=2_000)
    t.upsert(spark.range(20_000).select(F.lit("k").alias("a"), F.col("id").cast("int").alias("b"), F.lit(1).alias("day"), F.col("id").alias("x")))
    v, seen = t.version(), []
    load = t._load
    t._load = lambda files, schema: seen.append(files) or load(files, schema)
    t.locate(spark.range(10 ** 6, 10 ** 6 + 400).select(F.lit("k").alias("a"), F.col("id").cast("int").alias("b")), v)
    assert sum(map(len, seen)) <= 2  # 400 absent keys, a chance of about 3e-4 each


def test_two_writers_lose_and_repeat_nothing(spark):
    t, errors = table(spark, 20), []

    def work(name):
        try:
            mine = LogTable(spark, t.path, t.key, t.stats, 20)
            for i in range(3):
                mine.upsert(spark.createDataFrame([(name, j, i, i) for j in range(i + 3)] + [("shared", 0, i, i)], SCHEMA), txn=(name, i))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in ("one", "two")]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert not errors and t.version().number == 6
    rows = state(t)
    assert [r for r in rows if r[0] != "shared"] == [(n, j, 2, 2) for n in ("one", "two") for j in range(5)]
    assert len([r for r in rows if r[0] == "shared"]) == 1


def test_a_writer_that_loses_the_race_writes_again_only_if_its_files_changed(spark, monkeypatch):
    t = table(spark, 10)
    t.upsert(spark.createDataFrame([("k", i, 0, i) for i in range(40)], SCHEMA))
    other, real, written = LogTable(spark, t.path, t.key, t.stats, 10), tablelog.create_if_absent, []
    write = t._write
    t._write = lambda rows, n: written.append(n) or write(rows, n)

    def first(key):
        def race(spark_, path, text):
            monkeypatch.setattr(tablelog, "create_if_absent", real)
            other.upsert(spark.createDataFrame([key], SCHEMA))
            return real(spark_, path, text)
        monkeypatch.setattr(tablelog, "create_if_absent", race)

    first(("new", 1, 0, 0))
    t.upsert(spark.createDataFrame([("k", 3, 1, 1)], SCHEMA))
    assert len(written) == 1
    first(("k", 3, 2, 2))  # the same key: the file this writer read is gone
    t.upsert(spark.createDataFrame([("k", 3, 3, 3)], SCHEMA))
    assert len(written) == 3
    assert t.read().count() == 41 and t.read().where("a = 'k' and b = 3").collect()[0].x == 3


def test_killed_writers_and_replays(spark, monkeypatch):
    t = table(spark)
    t.upsert(spark.createDataFrame([("k", 1, 1, 1)], SCHEMA), txn=("app", 0))
    before = state(t)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tablelog, "create_if_absent", die)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(spark.createDataFrame([("k", 1, 2, 2)], SCHEMA), txn=("app", 1))
    with monkeypatch.context() as m:
        m.setattr(tablelog.F, "bit_or", die)  # between data files and manifest
        with pytest.raises(KeyboardInterrupt):
            t.upsert(spark.createDataFrame([("k", 2, 2, 2)], SCHEMA), txn=("app", 1))
    assert state(t) == before and t.version().number == 1
    for _ in range(3):
        t.upsert(spark.createDataFrame([("k", 1, 2, 2)], SCHEMA), txn=("app", 1))
    assert state(t) == [("k", 1, 2, 2)] and t.version().number == 2
    t.upsert(spark.createDataFrame([("k", 9, 9, 9)], SCHEMA), txn=("app", 0))  # an older batch again
    assert state(t) == [("k", 1, 2, 2)]
    assert t.remove_orphans(older_than_s=0) == 2 and state(t) == [("k", 1, 2, 2)]
    t.replace(spark.createDataFrame([("z", 1, 1, 1)], SCHEMA))
    assert state(t) == [("z", 1, 1, 1)] and t.read(2).count() == 1
    t.replace(spark.createDataFrame([], SCHEMA))
    assert state(t) == [] and t.upsert(spark.createDataFrame([("z", 1, 1, 1)], SCHEMA)) == 5
