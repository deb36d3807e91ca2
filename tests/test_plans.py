"""Plan guards: no registered batch query plans a nested-loop join, a
Cartesian product or row-at-a-time Python, and scans read only needed
columns."""

import pytest

from conftest import SF_SMALL

from fieldcat.plans.queries import QUERIES

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_or_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in FORBIDDEN if w in plan]


def test_flagship_scan_is_pruned(spark):
    plan = QUERIES["job_final_status"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # the job status never needs the document text
    assert "documents.parquet" in plan and "text:string" not in plan


@pytest.mark.parametrize("name", ["job_lookup", "unstarted_jobs", "next_job", "pending_terminal"])
def test_job_lookups_read_no_log(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" in plan and "props" not in plan
