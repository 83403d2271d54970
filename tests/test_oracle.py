"""Every named query against its oracle SQL on the smallest tables.

Broadcast joins are switched off, so that the joins run as they would on large tables, and the plans
are searched for shapes that do not scale.
"""

import pytest

import __spark_entry__ as entry
from oracle_sql_text import ORACLE
from salesops.plans.registry import QUERIES
from tests.conftest import SF
from tools.check_oracle import compare, oracle_connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date_year", "date_month", "month_sum", "month_mean_price"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def large_joins(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, large_joins, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for shape in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert shape not in plan
    assert compare(df, oracle_connection(SF), ORACLE[name]) is None
