"""Driver contract and streaming-equals-batch checks."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import logs as LG
from tessera.session import Tables
from tessera.streaming import streams as ST
from tests.conftest import SF001, rows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_every_sql_key_has_a_query():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 150


def test_stream_usage_equals_batch(spark):
    ev = Tables(spark, SF001).events
    stream = spark.readStream.schema(ev.schema).parquet(f"{SF001}/events.parque[t]")
    body = F.concat(F.lit('{"usage": {"prompt_tokens": '), F.get_json_object("props", "$.k"), F.lit("}}"))
    s = ST.stream_usage(stream.select("ts", F.col("user_id").alias("org_id"), body.alias("body")), delay="40 days")
    got = ST.run_available(s, "usage-test", keys=["org_id", "minute"], mode="update")
    b = LG.usage_fields(ev.select("ts", F.col("user_id").alias("org_id"), body.alias("body")))
    want = b.groupBy("org_id").agg(F.sum("llm_input_tokens").alias("t"))
    g = got.groupBy("org_id").agg(F.sum("llm_input_tokens").alias("t"))
    assert sorted(rows(g)) == sorted(rows(want))


def test_stream_memory_equals_batch(spark):
    conv = Tables(spark, SF001).conversations
    stream = spark.readStream.schema(conv.schema).parquet(f"{SF001}/conversations.parque[t]")
    got = ST.run_available(ST.stream_memory(stream.select("conv_id", "turn", "role", "text"), 4), "mem-test",
                           mode="update")
    latest = got.groupBy("conv_id", "turn").count()
    want = LG.memory_window(conv, 4).select("conv_id", "turn")
    assert sorted(rows(latest.select("conv_id", "turn"))) == sorted(rows(want))


def test_filter_route_stream_equals_batch(spark):
    ev = Tables(spark, SF001).events
    stream = spark.readStream.schema(ev.schema).parquet(f"{SF001}/events.parque[t]")
    spec = [("event_type", "equals", "click")]
    got = ST.run_available(ST.stream_filter_route(stream, conditions=spec).select("event_id"), "fr-test")
    want = ev.filter(F.col("event_type") == "click").select("event_id")
    assert sorted(rows(got)) == sorted(rows(want))


def test_second_run_takes_only_new_input(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    schema = "conv_id long, turn long, role string, text string"
    rows = lambda *turns: spark.createDataFrame([(1, t, "user", f"t{t}") for t in turns], schema)
    run = lambda s, **k: ST.run_available(s, "twice", target=out, checkpoint=ckpt, **k)
    rows(1, 2).coalesce(1).write.mode("append").json(src)
    stream = ST.landing_stream(spark, src, schema)
    assert sorted(r["turn"] for r in run(stream).collect()) == [1, 2]
    assert sorted(r["turn"] for r in run(stream).collect()) == [1, 2]  # nothing new, nothing twice
    rows(3).coalesce(1).write.mode("append").json(src)
    assert sorted(r["turn"] for r in run(stream).collect()) == [1, 2, 3]


def test_repeated_batch_is_stored_once(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    for _ in range(2):
        ST.write_batch(df, 0, str(tmp_path))
    ST.write_batch(df.where("id > 1"), 1, str(tmp_path))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path)).collect())) == [(1, 0), (2, 0), (2, 1)]


def test_stream_memory_over_two_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "conv_id long, turn long, role string, text string"
    for turns in ((1, 2), (4, 5)):
        spark.createDataFrame([(1, t, "user", f"t{t}") for t in turns], schema).coalesce(1).write.mode("append").json(src)
    stream = ST.landing_stream(spark, src, schema, max_files=1)
    got = ST.run_available(ST.stream_memory(stream, 2), "mem2", mode="update", group=["conv_id"])
    assert sorted(r["turn"] for r in got.collect()) == [4, 5]
