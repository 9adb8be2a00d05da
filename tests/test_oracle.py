"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

#: The operators and feeds; queries of other packages are tested beside them.
NAMES = sorted(name for name in E.queries() if name.startswith("q_"))
SF = os.environ.get("FEEDKIT_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_sql():
    assert {name for name in E.oracle_sql() if name.startswith("q_")} == set(NAMES)


def test_entry_runs(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF, name, E.queries()[name], E.oracle_sql().get(name))
    assert r["status"] == "ok", r
