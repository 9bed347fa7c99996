"""Every registered query against its SQL, and row counts for those without."""

from __future__ import annotations

import os

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tripmarts.plans.oracles import ORACLES
from tripmarts.plans.queries import REGISTRY as QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Pairs of all rows, and row data sent to Python workers.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in UNWANTED:
        assert operator not in plan
    assert compare.assert_same(df, duck, ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
