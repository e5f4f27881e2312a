"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from punctual import catalog
from tests.conftest import SF_SMALL
from tests.helpers import rows

NAMES = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = df.toPandas()
    # no query pairs rows up: no cartesian or nested-loop join in its plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_entry_is_the_mart(spark):
    df = E.entry(spark)
    assert df.columns == ["route_id", "stop_name", "direction_id", "total_arrivals",
                          "avg_delay_min", "earliest_min", "latest_min", "on_time_count",
                          "on_time_pct"]
    assert df.count() == 50
