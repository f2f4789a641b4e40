import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from conftest import SF
from doclog.plans import catalog


# Pairs of rows without a key, and rows leaving the JVM.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(catalog.QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
