"""Plan guardrails for every registered query (physical plans, no execution)."""

import re

import pytest

import __spark_entry__ as E
from tramline.plans.catalog import QUERIES
from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python_udf(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_scans_are_pruned(spark, name):
    """No registered query reads a driver-table column it does not use."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for unused in ("l_quantity", "l_extendedprice", "o_totalprice", "props", "s_name", "n_name"):
        assert not re.search(rf"\b{unused}\b", plan), f"{name} reads {unused}"
