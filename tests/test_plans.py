"""Plan guards for every registered query: no cartesian products or
nested-loop joins (all joins are equi-joins), and scans read only the
columns the query uses."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# model-fitting and streaming jobs run eagerly and are covered elsewhere
SKIP = {"m1", "m5", "m6", "m7", "m8", "m8_pairs", "m4", "m10", "m11", "m12", "m13", "m14", "m15", "e6", "t1", "c15"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name


def test_bars_scan_is_pruned(spark):
    plan = E.queries()["a1"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan
