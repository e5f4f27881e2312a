"""The streamed fact at size: batches of new arrivals look up nothing to write them."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from punctual.config import PipelineConfig
from punctual.plans import transit as T
from punctual.sinks import tablelog
from punctual.streaming import arrival_state as st
from tests.helpers import north, rows
from tests.test_arrival_state import T0, apply, fixture


def of_hour(h, trip):
    return [("R", trip, "v1", north(43.6, 60.0 * i), -79.4, T0 + dt.timedelta(hours=h, minutes=2 * i)) for i in range(4)]


def test_new_arrivals_are_written_without_a_search_unless_others_wrote_the_fact(spark, monkeypatch):
    store, fact_path = (tempfile.mkdtemp(prefix="punctual-test-") + "/t" for _ in "ab")
    first, second, third = (of_hour(h, t) for h, t in enumerate(("T1", "T2", "X")))
    third = [(r, t, v, la, lo, at - dt.timedelta(hours=2)) for r, t, v, la, lo, at in third]  # late, at the first's times
    third[0] = (*third[0][:5], T0 + dt.timedelta(minutes=3))
    searched, real = [], tablelog.LogTable.locate
    monkeypatch.setattr(tablelog.LogTable, "locate", lambda self, *a: searched.append(self.path) or real(self, *a))
    apply(spark, first, 0, store, fact_path)
    apply(spark, second, 1, store, fact_path)
    assert searched == []
    facts = st.fact_table(spark, fact_path)
    assert rows(facts.read().toPandas()) == rows(T.fact(fixture(spark, first + second), PipelineConfig()).toPandas())
    # another writer's row at a key that the third batch writes
    facts.upsert(facts.read().where("stop_id = 's0'").limit(1).withColumn("actual_arrival", F.lit(T0 + dt.timedelta(minutes=3))))
    searched.clear()
    apply(spark, third, 2, store, fact_path)
    assert fact_path in searched
    assert rows(facts.read().toPandas()) == rows(T.fact(fixture(spark, first + second + third), PipelineConfig()).toPandas())


def test_a_commit_deals_each_bucket_to_a_task_of_its_own(spark):
    table = tablelog.LogTable(spark, tempfile.mkdtemp(prefix="punctual-test-") + "/t", ["k"], rows_per_file=500)
    table.upsert(spark.range(8000).select(F.col("id").alias("k")))
    names = [r.file for r in table.files(table.version()).collect()]
    assert len(names) == 16 and len({n.split("/part-")[1].split("-")[0] for n in names}) == 16  # a file is named after its task
