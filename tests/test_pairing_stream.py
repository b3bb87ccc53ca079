"""Call pairing on a stream: pairs at once, leaves at the time limit, loses nothing."""

import datetime as dt

from tessera.streaming import streams as ST

SCHEMA = "run_id string, call_id string, type string, ts timestamp, tool string, result string"


def land(spark, path, *rows):
    at = dt.datetime(2024, 1, 1)
    data = [(r, c, kind, at + dt.timedelta(seconds=sec), "t" if kind == "call" else None, "ok" if kind == "result" else None) for r, c, kind, sec in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def sides(spark, path):
    s = ST.landing_stream(spark, path, SCHEMA, "parquet", max_files=1)
    return s.where("type = 'call'"), s.where("type = 'result'")


def seen(df):
    return sorted(((r["run_id"], r["call_id"], r["duration_s"], r["call_ts"] is None, r["result_ts"] is None) for r in df.collect()), key=str)


PAIRED, NO_CALL, NO_RESULT = (False, False), (True, False), (False, True)


def test_every_row_leaves_once(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    run = lambda: seen(ST.pair_calls_now(*sides(spark, src), "30 seconds", "5 seconds", target=out, checkpoint=ckpt))
    land(spark, src, ("r", "a", "call", 0), ("r", "a", "result", 30), ("r", "b", "call", 1), ("r", "c", "result", 2), ("r", "d", "call", 28), ("s", "a", "result", 29))
    first = run()
    assert first == sorted([("r", "a", 30.0, *PAIRED), ("r", "b", None, *NO_RESULT), ("r", "c", None, *NO_CALL), ("r", "d", None, *NO_RESULT), ("s", "a", None, *NO_CALL)], key=str)
    # what waited for a partner is still paired by a later run; what timed out stays as it left
    land(spark, src, ("r", "d", "result", 40), ("x", "y", "call", 500))
    land(spark, src, ("r", "b", "result", 501))
    second = run()
    assert second == sorted([("r", "a", 30.0, *PAIRED), ("r", "b", None, *NO_RESULT), ("r", "b", None, *NO_CALL), ("r", "c", None, *NO_CALL), ("r", "d", 12.0, *PAIRED),
                             ("s", "a", None, *NO_CALL), ("x", "y", None, *NO_RESULT)], key=str)
    left = {(r["run_id"], r["call_id"]) for r in ST.waiting_calls(spark, ckpt).collect()}
    assert left == {("x", "y"), ("r", "b")}  # the others have left the state


def test_bound_and_order(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, ("r", "late", "call", 0), ("r", "late", "result", 31), ("r", "before", "result", 5), ("r", "before", "call", 6),
         ("r", "two", "call", 1), ("r", "two", "call", 2), ("r", "two", "result", 3), ("r", None, "call", 4))
    got = seen(ST.pair_calls_now(*sides(spark, src), "30 seconds", "1 minute"))
    assert got == sorted([("r", "late", None, *NO_RESULT), ("r", "late", None, *NO_CALL), ("r", "before", None, *NO_RESULT), ("r", "before", None, *NO_CALL),
                          ("r", "two", 2.0, *PAIRED), ("r", "two", 1.0, *PAIRED), ("r", None, None, *NO_RESULT)], key=str)


def test_runs_in_a_session_with_the_default_state_store(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, ("r", "a", "call", 0), ("r", "a", "result", 7), ("r", "b", "call", 1))
    held = spark.conf.get(ST.STATE_STORE)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(ST.STATE_STORE, default)
    try:
        got = seen(ST.pair_calls_now(*sides(spark, src), "30 seconds", "5 seconds"))
        assert spark.conf.get(ST.STATE_STORE) == default
    finally:
        spark.conf.set(ST.STATE_STORE, held)
    assert got == sorted([("r", "a", 7.0, *PAIRED), ("r", "b", None, *NO_RESULT)], key=str)


def test_no_python_worker_per_call(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, ("r", "a", "call", 0))
    plan = ST.stream_pair_calls(*sides(spark, src))._jdf.queryExecution().analyzed().toString()
    assert "Join FullOuter" in plan and "Pandas" not in plan and "Python" not in plan


def test_one_state_store_for_both_sides(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    land(spark, src, ("r", "a", "call", 0), ("r", "a", "result", 7))
    held = {k: spark.conf.get(k, None) for k in ST.PAIRING}
    ST.pair_calls_now(*sides(spark, src), target=out, checkpoint=ckpt)
    assert held == {k: spark.conf.get(k, None) for k in ST.PAIRING}
    assert not [p.name for p in (tmp_path / "ckpt" / "state" / "0" / "0").iterdir() if p.name.startswith(("left-", "right-"))]


def test_null_ids_late_rows_and_a_side_that_stops(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    run = lambda: seen(ST.pair_calls_now(*sides(spark, src), "30 seconds", "5 seconds", target=out, checkpoint=ckpt))
    land(spark, src, ("r", None, "call", 0), ("r", None, "result", 4), (None, "b", "call", 1), (None, "b", "result", 2), ("r", "c", "call", 3))
    first = [("r", None, 4.0, *PAIRED), (None, "b", 1.0, *PAIRED), ("r", "c", None, *NO_RESULT)]
    assert run() == sorted(first, key=str)
    # only results land from here on: the watermark follows them, and the call that waits leaves
    land(spark, src, ("r", "d", "result", 100))
    assert run() == sorted([*first, ("r", "d", None, *NO_CALL)], key=str)
    assert {(r["run_id"], r["call_id"]) for r in ST.waiting_calls(spark, ckpt).collect()} == {("r", "d")}
    # rows behind the watermark are not taken any more
    land(spark, src, ("r", "c", "result", 20), ("r", "d", "call", 99))
    assert run() == sorted([*first, ("r", "d", 1.0, *PAIRED)], key=str)
