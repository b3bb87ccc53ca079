"""Plan review for every registered batch query: no row-at-a-time Python
UDF (``BatchEvalPython``), no join of all pairs (cartesian or nested loop) and
no window without a partition key (which would pull all rows into one task)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

STREAMING = {k for k in E.queries() if k.startswith("stream_")} | {
    "webhook_source", "feed_poll", "ingest_bridge", "scheduled_batch", "export_answers"}
KEYS = sorted(k for k in E.queries() if k not in STREAMING)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_plan_is_distributed(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    assert "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        # a spec that starts with an ordering (ASC/DESC) or frame has no partition key
        first = spec.split(",")[0].strip()
        assert not (first.endswith(("ASC NULLS FIRST", "ASC NULLS LAST", "DESC NULLS FIRST", "DESC NULLS LAST"))
                    or first.startswith("specifiedwindowframe")), (key, spec)
