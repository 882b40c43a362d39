"""Plan properties: no cross joins, no Python UDFs, filters and pruning at the scan."""

import pytest

from stayrate.plans import ORACLES, QUERIES

from conftest import SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_cross_join_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_flagship_pushes_filters_and_prunes_columns(spark):
    df = QUERIES["customer_features"](spark, SMALL)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "LessThan(l_shipdate" in text             # as_of cut reaches the lineitem scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double," \
           "l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    df.collect()                                     # final adaptive plan: codegen stages
    assert "*(" in df._jdf.queryExecution().executedPlan().toString()
