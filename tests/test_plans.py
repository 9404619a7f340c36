"""No job may fall back to Python rows, pair everything with everything, or use one task."""

from __future__ import annotations

import re

import pytest

import __spark_entry__  # noqa: F401 - registers the jobs
from tidemark.plans.registry import JOBS

FOLDER = "/root/testdata/sf0.001"
BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SortAggregate"]


@pytest.mark.parametrize("name", sorted(JOBS))
def test_plan(spark, name):
    plan = JOBS[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    nodes = "\n".join(re.split(r"[\[(]", line)[0] for line in plan.splitlines())
    for node in BANNED:
        if node == "SortAggregate" and name == "watermark":
            continue  # over text combined early
        assert node not in nodes, plan
    # One task is only for results that are already one row per partition.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "partial_" in lines[i + 1], plan
