"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.queries import ORACLES, QUERIES

SF_DIR = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no query pairs all rows or leaves the JVM
    assert not [o for o in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python") if o in plan]
    assert compare(df, con, name).startswith("ok")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
