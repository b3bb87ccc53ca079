"""Structured Streaming forms of the operators.

Sources are folders where files land (uploads, feeds, logs); every query has
a checkpoint; a restarted or re-scheduled query that is given the target and
checkpoint of its last run resumes there. Results leave through ``foreachBatch``
into a table with one ``_batch`` partition per micro-batch; a batch that is
repeated after a failure replaces its own partition, so nothing is stored
twice. ``latest`` reads such a table back as "newest row per key", which is how
update-mode aggregates are drained without a driver-side sink.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators import filters as FL
from tessera.operators import logs as LG
from tessera.operators import routing as R
from tessera.session import ensure_checkpoint_dir
from tessera.sources.versioned import VersionedTable

# ------------------------------------------------------------------ sources


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need ``TIMESTAMP``; wall-clock ``TIMESTAMP_NTZ`` columns are
    read as UTC instants."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.to_utc_timestamp(F.col(ts), "UTC").cast("timestamp"))
    return df


def landing_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
                   max_files: int | None = None) -> DataFrame:
    """Files landing in a folder as a stream (webhook / upload intake)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def stream_dedupe(stream: DataFrame, key: str | Sequence[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """Each key once while it can still arrive late (state bounded by the watermark)."""
    keys = [key] if isinstance(key, str) else list(key)
    return _event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def feed_stream(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "entry_id",
                ts: str = "published", delay: str = "1 day") -> DataFrame:
    """New feed entries once (JSON feed files landing in a folder)."""
    return stream_dedupe(landing_stream(spark, path, schema), key, ts, delay)


# -------------------------------------------------------------------- sinks


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage
    on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


def write_batch(batch: DataFrame, batch_id: int, path: str, fmt: str = "parquet") -> None:
    """Store a micro-batch as the ``_batch`` partition of its id."""
    batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/_batch={batch_id}")


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
          trigger_available_now: bool = True, fmt: str = "parquet") -> None:
    """Run a stream into ``path`` through ``foreachBatch``: each micro-batch
    is a ``_batch`` partition; partition -1 is empty and makes the table exist
    without any input. ``availableNow`` processes what has landed and stops
    (the scheduled-batch form)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, fmt)

    write_batch(stream.sparkSession.createDataFrame([], stream.schema), -1, path, fmt)

    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    q = w.trigger(availableNow=True).start() if trigger_available_now else w.start()
    q.awaitTermination()


def latest(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Newest row per key of a drained update-mode table (partial ``max_by``)."""
    df = spark.read.format(fmt).load(path)
    cols = [c for c in df.columns if c != "_batch"]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("_batch")).alias("_r"))
    return g.select("_r.*")


def newest_batch(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """All rows that the last micro-batch with the key wrote for it: the state
    of operators that put out several rows per key each time."""
    df = spark.read.format(fmt).load(path)
    last = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_batch").alias("_last"))
    same = F.col("_batch") == F.col("_last")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(last, same, "left_semi").drop("_batch")


def run_available(stream: DataFrame, name: str, keys: Sequence[str] | None = None, mode: str = "append",
                  group: Sequence[str] | None = None, target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Scheduled batch: process all available input now, then read the result:
    the newest row per ``keys`` or the newest batch per ``group`` for update
    mode, else all rows. Given ``target`` and ``checkpoint``, a further run
    takes only input that is new since the last one, and the result is that of
    all runs; without them each run starts afresh."""
    if (target is None) != (checkpoint is None):
        raise ValueError("target and checkpoint belong together")
    spark = stream.sparkSession
    path = target or scratch_path(spark, f"{name}-out")
    drain(stream, path, checkpoint or scratch_path(spark, f"{name}-ckpt"), mode)
    if keys:
        return latest(spark, path, keys)
    if group:
        return newest_batch(spark, path, group)
    return spark.read.parquet(path).drop("_batch")


# ------------------------------------------------------------- operators


def stream_filter_route(stream: DataFrame, conditions: Sequence | None = None,
                        rules: Sequence[dict] | None = None, combinator: str = "and") -> DataFrame:
    """Item filter and switch on a stream: the batch functions, unchanged."""
    s = stream
    if conditions:
        s = FL.filter_rows(s, conditions, combinator)
    if rules:
        s = R.switch_rules(s, rules)
    return s


def stream_usage(stream: DataFrame, body_col: str = "body", org_col: str = "org_id", ts_col: str = "ts",
                 window: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Usage counters per org and minute; rows later than the watermark are
    dropped (ours: 10 minutes). Run in update mode."""
    f = _event_time(LG.usage_fields(stream, body_col), ts_col)
    return f.withWatermark(ts_col, delay).groupBy(F.window(ts_col, window).alias("w"), org_col).agg(
        F.count(F.lit(1)).alias("call_count"), F.sum("llm_input_tokens").cast("long").alias("llm_input_tokens"),
        F.sum("llm_output_tokens").cast("long").alias("llm_output_tokens"),
        F.sum("embed_tokens").cast("long").alias("embed_tokens")).select(
        org_col, F.col("w.start").alias("minute"), "call_count", "llm_input_tokens", "llm_output_tokens", "embed_tokens")


def _paired(df: DataFrame, run_col: str, call_col: str) -> DataFrame:
    at = lambda c: F.timestamp_micros(c)
    return df.select(F.col("run").alias(run_col), F.col("call").alias(call_col), "tool", at("call_us").alias("call_ts"), at("result_us").alias("result_ts"), "result",
                     F.round((F.col("result_us") - F.col("call_us")) / 1e6, 6).alias("duration_s"))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: what call pairing is started with: state on disk, one store per partition for
#: both sides of the join (Spark's default layout keeps four), and a watermark
#: that follows the newest event of either side
PAIRING = {STATE_STORE: ROCKSDB, "spark.sql.streaming.join.stateFormatVersion": "3", "spark.sql.streaming.multipleWatermarkPolicy": "max"}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside run with the settings of ``PAIRING``, their state
    in RocksDB; the session's own settings come back afterwards."""
    held = {k: spark.conf.get(k, None) for k in PAIRING}
    try:
        for k, v in PAIRING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in held.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stream_pair_calls(calls: DataFrame, results: DataFrame, bound: str = "30 seconds", delay: str = "10 seconds",
                      run_col: str = "run_id", call_col: str = "call_id", ts_col: str = "ts") -> DataFrame:
    """Live call/result pairing, a stream-stream full outer join on (run, call
    id), null ids being equal: a result within ``bound`` after its call is
    paired at once; a call without one leaves, with nulls, when the watermark
    (``delay`` behind the newest event) passes its time limit, and a result
    without call when no earlier call can come any more. ``calls`` has a
    ``tool``, ``results`` may have a ``result``. Append mode; start it within
    ``rocksdb_state``."""
    def side(df: DataFrame, kind: str) -> DataFrame:
        text = lambda c: (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
        rows = _event_time(df, ts_col).select(F.col(run_col).cast("string").alias("run"), F.col(call_col).cast("string").alias("call"),
                                              F.unix_micros(F.col(ts_col).cast("timestamp")).alias("us"), text("tool"), text("result")).where("us IS NOT NULL")
        return rows.withColumn("at", F.timestamp_micros("us")).withWatermark("at", delay).alias(kind)

    zero = F.timestamp_micros(F.lit(0))
    bound_us = calls.sparkSession.range(1).select(F.unix_micros(zero + F.expr(f"INTERVAL {bound}"))).first()[0]
    limit = F.expr(f"INTERVAL '{bound_us // 10**6}.{bound_us % 10**6:06d}' SECOND")
    c, r = (lambda x: F.col(f"c.{x}")), (lambda x: F.col(f"r.{x}"))
    same = c("run").eqNullSafe(r("run")) & c("call").eqNullSafe(r("call"))
    j = side(calls, "c").join(side(results, "r"), same & (r("at") >= c("at")) & (r("at") <= c("at") + limit), "full_outer")
    # no row lacks both sides: naming the other side's text only keeps it in the state, where ``waiting_calls`` shows it
    neither = c("us").isNull() & r("us").isNull()
    return _paired(j.select(F.coalesce(c("run"), r("run")).alias("run"), F.coalesce(c("call"), r("call")).alias("call"), F.when(neither, r("tool")).otherwise(c("tool")).alias("tool"),
                            c("us").alias("call_us"), r("us").alias("result_us"), F.when(neither, c("result")).otherwise(r("result")).alias("result")), run_col, call_col)


def waiting_calls(spark: SparkSession, checkpoint: str, run_col: str = "run_id", call_col: str = "call_id") -> DataFrame:
    """Calls and results that still wait for a partner when a run of
    ``stream_pair_calls`` has ended, read from the state in its checkpoint; a
    later run with the same checkpoint may pair them yet."""
    def side(name: str, us: str, other: str) -> DataFrame:
        state = spark.read.format("statestore").option("path", checkpoint).option("storeName", f"{name}-keyWithIndexToValue").load()
        return state.where(~F.col("value.matched")).select("value.*").withColumn(us, F.col("us")).withColumn(other, F.lit(None).cast("long"))

    return _paired(side("left", "call_us", "result_us").unionByName(side("right", "result_us", "call_us")), run_col, call_col)


def pair_calls_now(calls: DataFrame, results: DataFrame, bound: str = "30 seconds", delay: str = "10 seconds",
                   target: str | None = None, checkpoint: str | None = None, **cols: str) -> DataFrame:
    """Scheduled pairing: every row that has landed is in the result, paired,
    timed out or still waiting. Given ``target`` and ``checkpoint``, a further
    run goes on from the state of the last one."""
    spark = calls.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "pairs-ckpt")
    with rocksdb_state(spark):
        done = run_available(stream_pair_calls(calls, results, bound, delay, **cols), "pairs", target=target or scratch_path(spark, "pairs-out"), checkpoint=checkpoint)
    names = {k: v for k, v in cols.items() if k != "ts_col"}
    return done.unionByName(waiting_calls(spark, checkpoint, **names))


MEMORY_SCHEMA = "conv_id long, turn long, role string, text string"


def stream_memory(stream: DataFrame, max_messages: int = 50, idle_timeout_ms: int | None = None) -> DataFrame:
    """Conversation memory kept per conversation across micro-batches
    (``applyInPandasWithState``). State holds at most the window: the system
    messages and the newest others; each batch emits the current window of
    every conversation it touched (update mode). For a continuous stream set
    ``idle_timeout_ms``: a conversation idle that long (processing time)
    drops its state, so state is bounded by the active conversations times
    the window. Scheduled ``availableNow`` runs keep no timeout (a
    processing-time timeout keeps a run scheduling empty batches)."""
    state_schema = "turns array<long>, roles array<string>, texts array<string>"
    empty = pd.DataFrame({"conv_id": pd.Series([], dtype="int64"), "turn": pd.Series([], dtype="int64"),
                          "role": pd.Series([], dtype="object"), "text": pd.Series([], dtype="object")})

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield empty
            return
        if state.exists:
            t, r, x = state.get
            cur = pd.DataFrame({"turn": list(t), "role": list(r), "text": list(x)})
        else:
            cur = pd.DataFrame({"turn": [], "role": [], "text": []})
        new = pd.concat([cur] + [p[["turn", "role", "text"]] for p in pdfs], ignore_index=True)
        new = new.drop_duplicates("turn", keep="last").sort_values("turn")
        system = new[new["role"] == "system"]
        others = new[new["role"] != "system"]
        if len(new) > max_messages:
            others = others.tail(max(max_messages - len(system), 0))
        kept = pd.concat([system, others]).sort_values("turn")
        state.update((kept["turn"].astype("int64").tolist(), kept["role"].tolist(), kept["text"].tolist()))
        if idle_timeout_ms:
            state.setTimeoutDuration(idle_timeout_ms)
        yield pd.DataFrame({"conv_id": [key[0]] * len(kept), "turn": kept["turn"].astype("int64"),
                            "role": kept["role"], "text": kept["text"]})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_timeout_ms else GroupStateTimeout.NoTimeout
    return stream.groupBy("conv_id").applyInPandasWithState(step, MEMORY_SCHEMA, state_schema, "update", timeout)


def stream_run_rollup(stream: DataFrame) -> DataFrame:
    """Incremental run-log rollup per run and block (update mode). State is
    one small row per (run, block) ever seen; for long-lived streams run it
    with the RocksDB state store, or window it by ``created_at`` with a
    watermark so finished runs leave the state."""
    ev = F.col("event")
    def n(kind: str):
        return F.sum(F.when(ev == kind, 1).otherwise(0)).cast("long").alias(kind)
    return stream.groupBy("run_id", "block_id").agg(n("started"), n("completed"), n("failed"), n("skipped"),
                                                    n("timeout"), F.sum("duration_ms").cast("long").alias("total_ms"))


def _upsert_batches(stream: DataFrame, table: VersionedTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], trigger_available_now: bool) -> None:
    """Every micro-batch replaces its documents in the table; a batch repeated
    after a failure is known by its number and changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.upsert(prepare(batch), writer=(checkpoint, batch_id))

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    q = w.trigger(availableNow=True).start() if trigger_available_now else w.start()
    q.awaitTermination()


def _newest(batch: DataFrame, key: str, order_col: str | None) -> DataFrame:
    """One row per key of a micro-batch: the highest by ``order_col``, else by all columns."""
    cols = [order_col] if order_col else []
    cols += [f.name for f in batch.schema.fields if not isinstance(f.dataType, T.MapType) and f.name != order_col]
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    return batch.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, F.struct(*[F.col(f"`{c}`") for c in cols])).alias("_r")).select("_r.*")


def start_ingest(stream: DataFrame, target: str, checkpoint: str, size: int = 512, overlap: int = 50,
                 dims: int = 256, collection: str = "default", trigger_available_now: bool = True, order_col: str | None = None) -> VersionedTable:
    """files -> chunk -> embed -> chunk table, per micro-batch. A document that
    comes again replaces all of its chunks, so a shorter version leaves none of
    the old ones; twice in one batch, the newest by ``order_col`` counts."""
    from tessera.plans.flows import CHUNK_SCHEMA, rag_ingest

    table = VersionedTable.open(stream.sparkSession, target, CHUNK_SCHEMA, "document_id")
    _upsert_batches(stream, table, checkpoint, lambda batch: rag_ingest(_newest(batch, "doc_id", order_col), collection, size, overlap, dims), trigger_available_now)
    return table


def bridge_to_collection(stream: DataFrame, target: str, checkpoint: str, key: str = "id",
                         collection: str = "default", trigger_available_now: bool = True, order_col: str | None = None) -> VersionedTable:
    """Carry incoming items into a collection table: each micro-batch is
    stamped with the collection and replaces the rows that share its keys."""
    schema = T.StructType([*stream.schema.fields, T.StructField("collection", T.StringType())])
    table = VersionedTable.open(stream.sparkSession, target, schema, key)
    _upsert_batches(stream, table, checkpoint, lambda batch: _newest(batch, key, order_col).withColumn("collection", F.lit(collection)), trigger_available_now)
    return table
