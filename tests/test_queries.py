"""Every registered query against its SQL twin; none may plan a cross join."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        problem = difference(df, con, SQL[name])
        assert problem in (None, "EMPTY"), problem
    else:
        assert df.count() > 0
