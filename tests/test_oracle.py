"""Every query against its SQL counterpart: names, types and all values."""

import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import ORACLES, QUERIES

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert ORACLES.items() <= oracle_sql().items() and QUERIES.items() <= queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    ours = QUERIES[name](spark, SF).toArrow()
    theirs = oracle.execute(ORACLES[name]).to_arrow_table()
    assert differences(ours, theirs) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_free_of_slow_paths(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for slow in ("NestedLoop", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert slow not in text


def test_entry(spark):
    assert entry(spark).count() > 0
