"""Every registered query agrees with its SQL on the smallest tables."""

import os

import pytest

from oracle import TESTDATA, connect, differences
from wavelode.plans.queries import QUERIES, SQL

FOLDER = f"{TESTDATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    assert differences(con, frame, SQL[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).collect()


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
