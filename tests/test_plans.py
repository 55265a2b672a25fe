"""Registered queries against DuckDB on the smallest tables; tests/oracle.py runs them all."""

import pytest

from driftwell.plans import all_plans
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
PLANS = all_plans()
# the slower families have tests of their own
QUICK = [n for n in PLANS if n[0] in "qmx" or n.startswith(("s3", "s8", "t4", "t8", "t12", "i1_", "i4_t", "c9", "k7", "r3", "r6"))]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUICK)
def test_plan(spark, con, name):
    fn, sql = PLANS[name]
    ok, _, why = compare(spark, con, SF, fn, sql)
    assert ok, why


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
