"""Plan-level guards for every registered query: no Python evaluation, no
cartesian product or nested-loop join; filters reach the scans."""
import os

import pytest

import __spark_entry__ as E

SF = os.environ.get("WARDFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_or_pairwise_operators(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not [op for op in FORBIDDEN if op in plan], plan


def test_filters_reach_the_scan_and_top1_is_partial(spark):
    plan = _plan(E.queries()["link_valid"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = _plan(E.queries()["last_movement"](spark, SF))
    assert "ReadSchema: struct<l_orderkey" in plan
