"""Every registered query against its DuckDB twin on the smallest test tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

import __spark_entry__ as se

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, canon  # noqa: E402

SF = os.environ.get("GATEWISE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() >= 0 and "visitor_num" in df.columns


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_twin(spark, con, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    twin = se.oracle_sql().get(name)
    if twin is None:
        assert len(rows) >= 1
        return
    res = con.execute(twin)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert canon(rows, df.columns) == canon(drows, dcols)
