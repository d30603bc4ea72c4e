"""Every registered query against its SQL on the smallest tables, and its plan."""

import pytest

from checks import load
from checks.compare import differences

QUERIES, SQL = load()
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas")


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    assert differences(df, duck, SQL[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [w for w in UNWANTED if w in plan] == []
    lines = plan.splitlines()
    for i, text in enumerate(lines):
        if "Window [" in text:  # no window over a whole table in one task
            assert "Exchange SinglePartition" not in "".join(lines[i + 1 : i + 3])
