"""What the physical plans of registered queries must not contain."""

import pytest

from __spark_entry__ import queries

# Streams run when called; their batch forms are covered here.
BATCH = sorted(n for n in queries() if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


def test_scan_reads_only_needed_columns(spark, sf):
    plan = queries()["lock_state"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "value" not in plan.split("ReadSchema")[1]
    assert "PushedFilters: [In(event_type" in plan
