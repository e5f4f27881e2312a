from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from punctual.session import get_session
    s = get_session("local[*]", app="punctual-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ["region", "nation", "orders", "lineitem", "events", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
