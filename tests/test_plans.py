"""Physical-plan guards for the scale properties the design relies on."""

from __future__ import annotations

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_proximity_join_broadcasts_the_stop_grid_and_prunes_columns(spark):
    plan = executed_plan(E.queries()["actual_arrivals"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "event_id" in ln]
    assert scan and all("props" not in ln and "value" not in ln for ln in scan)


def test_asof_is_two_window_passes_without_unbounded_following(spark):
    df = E.queries()["nearest_schedule"](spark, SF_SMALL)
    plan = executed_plan(df)
    windows = [ln for ln in plan.splitlines() if ln.strip(" +-:*()0123456789").startswith("Window")]
    assert len(windows) == 2
    assert "unboundedfollowing" not in plan.lower()
