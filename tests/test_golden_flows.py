"""Golden cases: tool-call limits and timeouts, payload truncation, and the
three flow templates (scheduled set -> filter -> aggregate, if -> append,
four-way switch)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import logs as LG
from tessera.operators import ordering as O
from tessera.plans import flows as X
from tests.conftest import rows

T0 = dt.datetime(2026, 1, 1, 0, 0, 0)


def _ts(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_call_limits(spark):
    calls = spark.createDataFrame(
        [("r1", i, _ts(i), "web" if i < 4 else "search") for i in range(6)],
        "run_id string, call_id int, ts timestamp, tool string")
    v = rows(LG.audit_call_limits(calls, {"web": 2}, max_tool_calls=5), "call_id", "violation")
    assert v == [(2, "tool limit 2 reached for web"), (3, "tool limit 2 reached for web"),
                 (5, "max_tool_calls 5 reached")]


def test_timeouts_and_missing_results(spark):
    ev = spark.createDataFrame([
        ("r", "1", "tool_call", "t", _ts(0), None), ("r", "1", "tool_result", None, _ts(10), "ok"),
        ("r", "2", "tool_call", "t", _ts(0), None), ("r", "2", "tool_result", None, _ts(45), "late"),
        ("r", "3", "tool_call", "t", _ts(0), None),
        ("r", "4", "tool_result", None, _ts(1), "refused"),
    ], "run_id string, call_id string, type string, tool_name string, ts timestamp, result string")
    p = J.pair_calls(ev)
    assert p.count() == 4  # the refused call's result is kept without a call
    got = sorted(rows(LG.audit_timeouts(p, 30), "call_id", "reason"))
    assert got == [("2", "timeout"), ("3", "no result")]


def test_truncation(spark):
    df = spark.createDataFrame([("x" * 9000,), ("short",)], "q string")
    out = [r[0] for r in rows(O.truncate_text(df, "q", 8000))]
    assert len(out[0]) == 8000 and out[1] == "short"
    noted = rows(O.truncate_text(df, "q", 10, "\n...[truncated from {total} to {kept} chars]"))[0][0]
    assert noted == "x" * 10 + "\n...[truncated from 9000 to 10 chars]"


def test_scheduled_sync(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, team string")
    out = X.scheduled_sync(df, [("source", "string", "cron")], [("team", "equals", "a")], None, [("count", "")])
    assert rows(out) == [(2,)]


def test_branch_flow(spark):
    df = spark.createDataFrame([(5,), (50,)], "n int")
    out = X.branch_flow(df, "n", "gt", 10, lambda t: t.withColumn("tag", F.lit("big")),
                        lambda f: f.withColumn("tag", F.lit("small")))
    assert sorted(rows(out, "n", "branch", "tag")) == [(5, "false", "small"), (50, "true", "big")]


def test_switch_flow(spark):
    df = spark.createDataFrame([(i,) for i in range(4)], "n int")
    rules = [{"output": f"o{i}", "conditions": [("n", "equals", i)]} for i in range(3)]
    out = X.switch_flow(df, rules, {"o0": lambda d: d.withColumn("x", F.lit(0))})
    got = sorted(rows(out, "n", "output"))
    assert got == [(0, "o0"), (1, "o1"), (2, "o2"), (3, "default")]
