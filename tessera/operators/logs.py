"""Event and usage logs: SSE parsing, captured web-search replies,
embedding replies, usage metering, conversation memory windows and agent
tool-call audits. All column expressions and grouped aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordering import carry_forward

# --------------------------------------------------------------------------
# S10 captured web-search replies
# --------------------------------------------------------------------------

_WEB_A = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("content", T.StringType())])))])
_WEB_B = T.StructType([T.StructField("organic", T.ArrayType(T.StructType([
    T.StructField("title", T.StringType()), T.StructField("link", T.StringType()),
    T.StructField("snippet", T.StringType())])))])
_WEB_C = T.StructType([T.StructField("web", T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("description", T.StringType())])))]))])


def normalize_web_results(df: DataFrame, provider_col: str = "provider", body_col: str = "body",
                          max_results: int = 10, keep: Sequence[str] = ()) -> DataFrame:
    """Three reply shapes to rows ``(pos, title, url, snippet)``:
    ``results[].content`` (all kept), ``organic[].link`` and
    ``web.results[].description`` (both cut to ``max_results``)."""
    p = F.col(provider_col)
    body = F.col(body_col)
    a = F.transform(F.from_json(body, _WEB_A)["results"], lambda r: F.struct(
        r["title"].alias("title"), r["url"].alias("url"), r["content"].alias("snippet")))
    b = F.slice(F.transform(F.coalesce(F.from_json(body, _WEB_B)["organic"], F.array()), lambda r: F.struct(
        r["title"].alias("title"), r["link"].alias("url"), r["snippet"].alias("snippet"))), 1, max_results)
    c = F.slice(F.transform(F.coalesce(F.from_json(body, _WEB_C)["web"]["results"], F.array()), lambda r: F.struct(
        r["title"].alias("title"), r["url"].alias("url"), r["description"].alias("snippet"))), 1, max_results)
    items = F.when(p == "results", a).when(p == "organic", b).when(p == "web", c)
    return df.select(*keep, provider_col, F.posexplode(items).alias("pos", "item")).select(
        *keep, provider_col, "pos", "item.title", "item.url", "item.snippet")


# --------------------------------------------------------------------------
# S11 embedding replies
# --------------------------------------------------------------------------

_EMB = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("index", T.LongType()),
                                                    T.StructField("embedding", T.ArrayType(T.DoubleType()))]))),
    T.StructField("model", T.StringType()),
    T.StructField("usage", T.StructType([T.StructField("prompt_tokens", T.LongType()),
                                         T.StructField("total_tokens", T.LongType())]))])


def unwrap_embeddings(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Embeddings reply: vectors in ``index`` order, dims of the first, count, tokens."""
    r = F.from_json(F.col(body_col), _EMB)
    sorted_ = F.array_sort(r["data"], lambda x, y: F.when(x["index"] < y["index"], -1)
                           .when(x["index"] > y["index"], 1).otherwise(0))
    vecs = F.transform(sorted_, lambda x: x["embedding"])
    return df.withColumn("embeddings", vecs).withColumn("model", r["model"]) \
        .withColumn("dimensions", F.coalesce(F.size(F.get(vecs, 0)), F.lit(0))) \
        .withColumn("count", F.size(vecs)).withColumn("tokens", r["usage"]["total_tokens"])


# --------------------------------------------------------------------------
# S12 / S13 server-sent events
# --------------------------------------------------------------------------


def parse_sse_lines(df: DataFrame, stream_col: str = "stream_id", line_no: str = "line_no",
                    line: str = "line") -> DataFrame:
    """Line dialect. ``event: X`` sets the type for the next data line; a
    parsed data line, a malformed one, and any other line clear it; an empty
    or ``[DONE]`` data line keeps it. Rows: data lines holding JSON; the
    type is copied in only when it is ``pipeline_step``.

    The "type in effect" is a carry-forward of the last marker before each
    line (skew-safe: a long stream is split across tasks).
    """
    ln = F.col(line)
    is_event = ln.startswith("event: ")
    is_data = ln.startswith("data: ")
    data = F.trim(F.substring(ln, 7, 1 << 30))
    keep = is_data & ((data == "") | (data == "[DONE]"))
    marker = F.when(is_event, F.trim(F.substring(ln, 8, 1 << 30))).when(keep, F.lit(None)).otherwise(F.lit(""))
    m = df.withColumn("_marker", marker)
    c = carry_forward(m, [stream_col], [line_no], "_marker", "_type", include_current=False)
    v = F.try_parse_json(data)
    out = c.filter(is_data & ~keep).withColumn("_v", v).filter(F.col("_v").isNotNull())
    own = F.try_variant_get(F.col("_v"), "$.type", "string")
    return out.select(stream_col, line_no, F.when(F.col("_type") == "pipeline_step", F.lit("pipeline_step"))
                      .otherwise(own).alias("type"), F.to_json(F.col("_v")).alias("data"))


def parse_sse_frames(df: DataFrame, id_col: str = "stream_id", text: str = "text") -> DataFrame:
    """Frame dialect: frames end with a blank line (a last frame without one
    is incomplete and dropped); ``event:`` sets the type (default
    ``message``), ``data:`` lines are trimmed and joined; frames without data
    or with bad JSON give no row."""
    frames = F.split(F.col(text), "\n\n")
    d = df.select(id_col, F.posexplode(frames).alias("frame_no", "frame"), F.size(frames).alias("_n"))
    d = d.filter(F.col("frame_no") < F.col("_n") - 1)
    lines = F.split("frame", "\n")
    ev = F.filter(lines, lambda l: l.startswith("event:"))
    d = d.withColumn("type", F.coalesce(F.trim(F.substring(F.try_element_at(ev, F.lit(-1)), 7, 1 << 30)), F.lit("message")))
    d = d.withColumn("_data", F.array_join(F.transform(F.filter(lines, lambda l: l.startswith("data:")),
                                                       lambda l: F.trim(F.substring(l, 6, 1 << 30))), ""))
    d = d.filter(F.col("_data") != "").withColumn("_v", F.try_parse_json("_data")).filter(F.col("_v").isNotNull())
    return d.select(id_col, "frame_no", "type", F.to_json("_v").alias("data"))


# --------------------------------------------------------------------------
# A11 usage metering
# --------------------------------------------------------------------------

# fixed values: counters of the usage summary
USAGE_AXES = ("llm_input_tokens", "llm_output_tokens", "search_calls", "rerank_calls", "ingest_pages",
              "execution_calls", "web_search_calls", "storage_bytes", "embed_tokens")


def _num(v: Column, path: str) -> Column:
    """A usage field counts only when it is a JSON number; truncated toward 0."""
    x = F.try_variant_get(v, path, "variant")
    t = F.schema_of_variant(x)
    isnum = t.isin("BIGINT", "DOUBLE", "DECIMAL") | t.startswith("DECIMAL")
    val = F.when(isnum, F.try_variant_get(v, path, "double"))
    return F.when(F.isnan(val) | F.abs(val).eqNullSafe(F.lit(float("inf"))), F.lit(None)).otherwise(val)


def usage_fields(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Per response body: input, output and embed tokens it adds.

    ``usage.prompt_tokens`` or ``usage.input_tokens`` (first number wins),
    ``usage.completion_tokens`` or ``usage.output_tokens``; if both are 0,
    ``usage.total_tokens`` counts as embed tokens. Bodies that are not
    objects, or have no usage object, only count the call. The body is
    parsed once into a variant column.
    """
    d = df.withColumn("_v", F.try_parse_json(F.col(body_col)))
    v = F.col("_v")
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    u = F.try_variant_get(v, "$.usage", "variant")
    u_obj = is_obj & F.coalesce(F.schema_of_variant(u).startswith("OBJECT"), F.lit(False))
    p = F.coalesce(_num(v, "$.usage.prompt_tokens"), _num(v, "$.usage.input_tokens"), F.lit(0.0))
    c = F.coalesce(_num(v, "$.usage.completion_tokens"), _num(v, "$.usage.output_tokens"), F.lit(0.0))
    tot = F.coalesce(_num(v, "$.usage.total_tokens"), F.lit(0.0))
    trunc = lambda x: F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("long")
    d = d.withColumns({"_u": u_obj, "_p": p, "_c": c, "_t": tot})
    llm = (F.col("_p") != 0) | (F.col("_c") != 0)
    zero = F.lit(0).cast("long")
    return d.withColumns({
        "llm_input_tokens": F.when(F.col("_u") & llm, trunc(F.col("_p"))).otherwise(zero),
        "llm_output_tokens": F.when(F.col("_u") & llm, trunc(F.col("_c"))).otherwise(zero),
        "embed_tokens": F.when(F.col("_u") & ~llm, trunc(F.col("_t"))).otherwise(zero),
    }).drop("_v", "_u", "_p", "_c", "_t")


def usage_meter(df: DataFrame, body_col: str = "body", by: Sequence[str] = ()) -> DataFrame:
    """Fold response bodies into usage counters per ``by`` key (one call per
    body; counters the bodies cannot carry stay 0; cost stays null)."""
    f = usage_fields(df, body_col)
    aggs = [F.count(F.lit(1)).alias("call_count")]
    for a in USAGE_AXES:
        if a in f.columns:
            aggs.append(F.sum(a).cast("long").alias(a))
        else:
            aggs.append(F.lit(0).cast("long").alias(a))
    g = f.groupBy(*by).agg(*aggs) if by else f.agg(*aggs)
    return g.withColumn("cost_estimate_usd", F.lit(None).cast("double"))


# --------------------------------------------------------------------------
# W3 / W4 conversation memory
# --------------------------------------------------------------------------


def memory_window(conv: DataFrame, max_messages: int = 50, session_col: str = "conv_id",
                  turn_col: str = "turn", role_col: str = "role") -> DataFrame:
    """Keep every system message and the newest others so that the total is
    at most ``max_messages`` (when system messages alone fill it, none of the
    others). Conversations within the limit are kept whole. System messages
    come first in ``position``.

    The newest-first ``row_number() <= max_messages`` is planned as a window
    group limit (map-side top-k per conversation) before the exact rule."""
    is_sys = F.col(role_col) == "system"
    counts = conv.groupBy(session_col).agg(F.count(F.lit(1)).alias("_n"),
                                           F.sum(F.when(is_sys, 1).otherwise(0)).alias("_s"))
    w = Window.partitionBy(session_col).orderBy(F.col(turn_col).desc())
    others = conv.filter(~is_sys).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_messages)
    others = others.join(counts, session_col).filter(
        (F.col("_n") <= max_messages) | (F.col("_rn") <= F.greatest(F.lit(max_messages) - F.col("_s"), F.lit(0))))
    system = conv.filter(is_sys).withColumn("_rn", F.lit(None).cast("int")).join(counts, session_col)
    out = system.unionByName(others).withColumn("_sys", F.when(F.col(role_col) == "system", 0).otherwise(1))
    return out.drop("_rn", "_n", "_s")


def memory_clear(conv: DataFrame, role_col: str = "role") -> DataFrame:
    """Only system messages stay."""
    return conv.filter(F.col(role_col) == "system")


# --------------------------------------------------------------------------
# W6 / W7 agent tool-call audits
# --------------------------------------------------------------------------

# fixed values: agent runtime limits
MAX_STEPS = 10
MAX_TOOL_CALLS = 5 * MAX_STEPS
TOOL_TIMEOUT_S = 30


def audit_call_limits(calls: DataFrame, limits: dict[str, int] | None = None, run_col: str = "run_id",
                      tool_col: str = "tool", ts_col: str = "ts", id_col: str = "call_id",
                      max_tool_calls: int = MAX_TOOL_CALLS) -> DataFrame:
    """Calls past a per-tool limit or past ``max_tool_calls`` in their run:
    running counts per (run, tool) and per run in call order."""
    from tessera.operators.ordering import positions

    limits = limits or {}
    lim = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))]) if limits \
        else F.create_map().cast("map<string,int>")
    # running counts are positions in call order (skew-safe: a run with a
    # third of all calls is split across tasks)
    c = positions(calls, [run_col, tool_col], [ts_col, id_col], name="tool_seq")
    c = positions(c, [run_col], [ts_col, id_col], name="run_seq")
    c = c.withColumn("tool_seq", F.col("tool_seq") + 1).withColumn("run_seq", F.col("run_seq") + 1)
    tool_lim = F.try_element_at(lim, F.col(tool_col))
    reason = F.when(tool_lim.isNotNull() & (F.col("tool_seq") > tool_lim),
                    F.concat(F.lit("tool limit "), tool_lim.cast("string"), F.lit(" reached for "), F.col(tool_col))) \
        .when(F.col("run_seq") > max_tool_calls, F.lit(f"max_tool_calls {max_tool_calls} reached"))
    return c.withColumn("violation", reason).filter(F.col("violation").isNotNull())


def audit_timeouts(paired: DataFrame, seconds: float = TOOL_TIMEOUT_S) -> DataFrame:
    """Calls over the time limit, or without a result."""
    return paired.filter(F.col("call_ts").isNotNull() & (
        F.col("result_ts").isNull() | (F.col("duration_s") > seconds))).withColumn(
        "reason", F.when(F.col("result_ts").isNull(), F.lit("no result")).otherwise(F.lit("timeout")))
