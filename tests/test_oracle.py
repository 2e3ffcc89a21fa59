"""Every query that has an independent DuckDB SQL, all reports among them, against it
(sf0.001)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from vodlens.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Date", "Area", "UType", "Folder", "TotalViews", "TotalCustomers", "TotalDuration"]


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["cols"], r
    assert r["match"], r
