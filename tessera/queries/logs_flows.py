"""Logs, metering, windows, search-time filters, flows, sources, streams and
user-operator queries.

Stand-ins derived from ``events`` (each rule only shapes rows; the operator
does the work): response bodies per event type for usage metering; SSE
lines/frames per event; run logs and agent events per user; tool calls per
click.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import scalars as C
from tessera.operators import aggregates as A
from tessera.operators import filters as FL
from tessera.operators import joins as J
from tessera.operators import logs as LG
from tessera.operators import ordering as O
from tessera.operators import registry as U
from tessera.operators import text as TX
from tessera.operators.ordering import positions
from tessera.plans import flows as X
from tessera.queries import docs_search as D
from tessera.queries import query
from tessera.session import Tables
from tessera.sources import feeds as FD
from tessera.sources import files as S
from tessera.sources.versioned import VersionedTable
from tessera.streaming import streams as ST

# ------------------------------------------------------------- usage bodies

_K = "json_extract_string(props, '$.k')"


def _bodies(spark, d):
    e = Tables(spark, d).events
    k = F.get_json_object("props", "$.k")
    body = (F.when(F.col("event_type") == "click", F.concat(
        F.lit('{"usage": {"prompt_tokens": '), k, F.lit(', "completion_tokens": '),
        (k.cast("int") % 7).cast("string"), F.lit("}}")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"usage": {"input_tokens": '), k,
                                                      F.lit(', "output_tokens": 3}}')))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"usage": {"total_tokens": '), k, F.lit("}}")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"usage": {"prompt_tokens": "'), k, F.lit('"}}')))
        .otherwise(F.concat(F.lit("["), k, F.lit("]"))))
    return e.select("event_id", "ts", F.col("user_id").alias("org_id"), body.alias("body"))


# the same response bodies, built and parsed in SQL
_BODIES_SQL = f"""
SELECT event_id, ts, user_id AS org_id, CASE event_type
  WHEN 'click' THEN '{{"usage": {{"prompt_tokens": ' || k || ', "completion_tokens": ' || CAST(CAST(k AS INTEGER) % 7 AS VARCHAR) || '}}}}'
  WHEN 'view' THEN '{{"usage": {{"input_tokens": ' || k || ', "output_tokens": 3}}}}'
  WHEN 'purchase' THEN '{{"usage": {{"total_tokens": ' || k || '}}}}'
  WHEN 'error' THEN '{{"usage": {{"prompt_tokens": "' || k || '"}}}}'
  ELSE '[' || k || ']' END AS body
FROM (SELECT *, {_K} AS k FROM events)"""


def _num_sql(path):
    return (f"CASE WHEN json_type(body, '{path}') IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') "
            f"THEN CAST(json_extract(body, '{path}') AS DOUBLE) END")


_FIELDS_SQL = f"""
SELECT *, CASE WHEN u AND (p <> 0 OR c <> 0) THEN CAST(trunc(p) AS BIGINT) ELSE 0 END AS llm_input_tokens,
  CASE WHEN u AND (p <> 0 OR c <> 0) THEN CAST(trunc(c) AS BIGINT) ELSE 0 END AS llm_output_tokens,
  CASE WHEN u AND p = 0 AND c = 0 THEN CAST(trunc(t) AS BIGINT) ELSE 0 END AS embed_tokens
FROM (SELECT *, coalesce(json_valid(body) AND json_type(body) = 'OBJECT' AND json_type(body, '$.usage') = 'OBJECT', false) AS u,
  coalesce({_num_sql('$.usage.prompt_tokens')}, {_num_sql('$.usage.input_tokens')}, 0) AS p,
  coalesce({_num_sql('$.usage.completion_tokens')}, {_num_sql('$.usage.output_tokens')}, 0) AS c,
  coalesce({_num_sql('$.usage.total_tokens')}, 0) AS t
  FROM ({_BODIES_SQL}))"""

_USAGE_SQL = f"""
SELECT org_id, count(*) AS call_count, CAST(sum(llm_input_tokens) AS BIGINT) AS llm_input_tokens,
  CAST(sum(llm_output_tokens) AS BIGINT) AS llm_output_tokens, CAST(sum(embed_tokens) AS BIGINT) AS embed_tokens
FROM ({_FIELDS_SQL}) GROUP BY org_id
"""


@query("usage_meter", _USAGE_SQL)
def usage_meter(spark, d):
    u = LG.usage_meter(_bodies(spark, d), "body", by=["org_id"])
    return u.select("org_id", "call_count", "llm_input_tokens", "llm_output_tokens", "embed_tokens")


# ------------------------------------------------------------------- SSE


def _sse_lines(spark, d):
    e = Tables(spark, d).events
    p = positions(e, ["user_id"], ["ts", "event_id"], name="pos")
    k = F.get_json_object("props", "$.k")
    ev = F.concat(F.lit("event: "), F.when(F.col("event_type") == "click", "pipeline_step").otherwise(F.col("event_type")))
    data = (F.when(F.col("event_type") == "error", F.lit("data: {bad json"))
            .when(F.col("event_type") == "signup", F.lit("data: [DONE]"))
            .otherwise(F.concat(F.lit('data: {"type": "'), F.col("event_type"), F.lit('", "k": '), k, F.lit("}"))))
    lines = F.array(F.struct(F.lit(0).alias("j"), ev.alias("line")), F.struct(F.lit(1).alias("j"), data.alias("line")),
                    F.struct(F.lit(2).alias("j"), F.lit("").alias("line")))
    x = p.select(F.col("user_id").alias("stream_id"), "pos", F.inline(lines))
    return x.select("stream_id", (F.col("pos") * 3 + F.col("j")).alias("line_no"), "line")


@query("sse_line_events", f"""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
l AS (
  SELECT user_id AS stream_id, pos * 3 AS line_no, 'event: ' || CASE WHEN event_type = 'click' THEN 'pipeline_step' ELSE event_type END AS line FROM p
  UNION ALL SELECT user_id, pos * 3 + 1, CASE WHEN event_type = 'error' THEN 'data: {{bad json' WHEN event_type = 'signup' THEN 'data: [DONE]'
    ELSE 'data: {{"type": "' || event_type || '", "k": ' || {_K} || '}}' END FROM p
  UNION ALL SELECT user_id, pos * 3 + 2, '' FROM p),
m AS (SELECT *, CASE WHEN starts_with(line, 'event: ') THEN trim(substr(line, 8))
    WHEN starts_with(line, 'data: ') AND trim(substr(line, 7)) IN ('', '[DONE]') THEN NULL ELSE '' END AS marker FROM l),
t AS (SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY stream_id ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cur FROM m)
SELECT stream_id, line_no, CASE WHEN cur = 'pipeline_step' THEN 'pipeline_step' ELSE json_extract_string(trim(substr(line, 7)), '$.type') END AS type,
  CAST(json_extract(trim(substr(line, 7)), '$.k') AS BIGINT) AS k
FROM t WHERE starts_with(line, 'data: ') AND trim(substr(line, 7)) NOT IN ('', '[DONE]') AND json_valid(trim(substr(line, 7)))
""")
def sse_line_events(spark, d):
    ev = LG.parse_sse_lines(_sse_lines(spark, d))
    return ev.select("stream_id", "line_no", "type", F.get_json_object("data", "$.k").cast("long").alias("k"))


def _sse_frames(spark, d):
    e = Tables(spark, d).events
    k = F.get_json_object("props", "$.k")
    first = F.when(F.col("event_type") == "error", F.lit("data: {bad\n\n")).otherwise(
        F.concat(F.lit("event: "), F.col("event_type"), F.lit('\ndata: {"k": '), k, F.lit("}\n\n")))
    text = F.concat(first, F.lit(': keep-alive\n\ndata: {"v":\ndata: 1}\n\ndata: {"tail": 1}'))
    return e.select(F.col("event_id").alias("stream_id"), text.alias("text"))


@query("sse_frame_events", f"""
WITH src AS (SELECT event_id AS stream_id,
    CASE WHEN event_type = 'error' THEN E'data: {{bad\\n\\n'
         ELSE 'event: ' || event_type || E'\\ndata: {{"k": ' || {_K} || E'}}\\n\\n' END
    || E': keep-alive\\n\\ndata: {{"v":\\ndata: 1}}\\n\\ndata: {{"tail": 1}}' AS text FROM events),
fr AS (SELECT stream_id, string_split(text, E'\\n\\n') AS frames FROM src),
ex AS (SELECT stream_id, frames[i] AS frame, i - 1 AS frame_no, len(frames) AS n
       FROM fr, LATERAL (SELECT unnest(range(1, len(frames) + 1)) AS i)),
p AS (SELECT stream_id, frame_no,
    coalesce(trim(substr(list_filter(string_split(frame, E'\\n'), lambda l: starts_with(l, 'event:'))[-1], 7)), 'message') AS type,
    array_to_string(list_transform(list_filter(string_split(frame, E'\\n'), lambda l: starts_with(l, 'data:')),
      lambda l: trim(substr(l, 6))), '') AS data
  FROM ex WHERE frame_no < n - 1)
SELECT stream_id, CAST(frame_no AS INTEGER) AS frame_no, type, CAST(json_extract(data, '$.k') AS BIGINT) AS k,
  CAST(json_extract(data, '$.v') AS BIGINT) AS v
FROM p WHERE data <> '' AND json_valid(data)
""")
def sse_frame_events(spark, d):
    f = LG.parse_sse_frames(_sse_frames(spark, d))
    return f.select("stream_id", F.col("frame_no").cast("int").alias("frame_no"), "type",
                    F.get_json_object("data", "$.k").cast("long").alias("k"),
                    F.get_json_object("data", "$.v").cast("long").alias("v"))


# --------------------------------------------------------- web / embeddings


def _web_bodies(spark, d):
    p = Tables(spark, d).pages
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    prov = F.when(host.endswith(".com"), "results").when(host.endswith(".net"), "organic").otherwise("web")
    title = F.concat(F.lit("page "), F.col("page_id").cast("string"))
    a = F.to_json(F.struct(F.array(F.struct(title.alias("title"), F.col("url").alias("url"), F.lit("c").alias("content"))).alias("results")))
    b = F.to_json(F.struct(F.array(F.struct(title.alias("title"), F.col("url").alias("link"), F.lit("s").alias("snippet")),
                                   F.struct(F.lit("extra").alias("title"), F.lit("x").alias("link"), F.lit("s").alias("snippet"))).alias("organic")))
    c = F.to_json(F.struct(F.struct(F.array(F.struct(title.alias("title"), F.col("url").alias("url"), F.lit("d").alias("description")),
                                            F.struct(F.lit("extra").alias("title"), F.lit("y").alias("url"), F.lit("d").alias("description"))).alias("results")).alias("web")))
    return p.select("page_id", prov.alias("provider"), F.when(prov == "results", a).when(prov == "organic", b).otherwise(c).alias("body"))


@query("web_results_normalize", r"""
WITH p AS (SELECT page_id, url, 'page ' || CAST(page_id AS VARCHAR) AS title,
    CASE WHEN suffix(host, '.com') THEN 'results' WHEN suffix(host, '.net') THEN 'organic' ELSE 'web' END AS provider
  FROM (SELECT *, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages)),
b AS (SELECT page_id, provider, CASE provider
    WHEN 'results' THEN json_object('results', json_array(json_object('title', title, 'url', url, 'content', 'c')))
    WHEN 'organic' THEN json_object('organic', json_array(json_object('title', title, 'link', url, 'snippet', 's'),
                                                       json_object('title', 'extra', 'link', 'x', 'snippet', 's')))
    ELSE json_object('web', json_object('results', json_array(json_object('title', title, 'url', url, 'description', 'd'),
                                                             json_object('title', 'extra', 'url', 'y', 'description', 'd')))) END AS body
  FROM p),
items AS (SELECT page_id, provider, CASE provider
    WHEN 'results' THEN list_transform(from_json(json_extract(body, '$.results'), '[{"title":"VARCHAR","url":"VARCHAR","content":"VARCHAR"}]'),
      lambda x: {'title': x.title, 'url': x.url, 'snippet': x.content})
    WHEN 'organic' THEN list_transform(from_json(json_extract(body, '$.organic'), '[{"title":"VARCHAR","link":"VARCHAR","snippet":"VARCHAR"}]'),
      lambda x: {'title': x.title, 'url': x.link, 'snippet': x.snippet})[1:1]
    ELSE list_transform(from_json(json_extract(body, '$.web.results'), '[{"title":"VARCHAR","url":"VARCHAR","description":"VARCHAR"}]'),
      lambda x: {'title': x.title, 'url': x.url, 'snippet': x.description})[1:1] END AS l FROM b)
SELECT page_id, provider, CAST(i - 1 AS INTEGER) AS pos, l[i].title AS title, l[i].url AS url, l[i].snippet AS snippet
FROM items, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)
""")
def web_results_normalize(spark, d):
    n = LG.normalize_web_results(_web_bodies(spark, d), max_results=1, keep=["page_id"])
    return n.select("page_id", "provider", "pos", "title", "url", "snippet")


@query("embeddings_unwrap", """
WITH b AS (SELECT vec_id, json_object('data', json_array(json_object('index', 1, 'embedding', embedding[1:4]),
    json_object('index', 0, 'embedding', embedding[5:8])), 'model', 'm',
    'usage', json_object('prompt_tokens', 7, 'total_tokens', 7)) AS body FROM embeddings),
r AS (SELECT vec_id, from_json(body, '{"data":[{"index":"BIGINT","embedding":"DOUBLE[]"}],"usage":{"total_tokens":"BIGINT"}}') AS j FROM b)
SELECT vec_id, CAST(coalesce(len(list_sort(j.data)[1].embedding), 0) AS INTEGER) AS dimensions, CAST(len(j.data) AS INTEGER) AS count,
  j.usage.total_tokens AS tokens, round(list_sort(j.data)[1].embedding[1], 5) AS first_value FROM r
""")
def embeddings_unwrap(spark, d):
    e = Tables(spark, d).embeddings
    body = F.to_json(F.struct(F.array(
        F.struct(F.lit(1).alias("index"), F.slice("embedding", 1, 4).alias("embedding")),
        F.struct(F.lit(0).alias("index"), F.slice("embedding", 5, 4).alias("embedding"))).alias("data"),
        F.lit("m").alias("model"), F.struct(F.lit(7).alias("prompt_tokens"), F.lit(7).alias("total_tokens")).alias("usage")))
    u = LG.unwrap_embeddings(e.select("vec_id", body.alias("body")))
    return u.select("vec_id", "dimensions", "count", "tokens",
                    F.round(F.get(F.get("embeddings", 0), 0), 5).alias("first_value"))


# -------------------------------------------------------------- front matter


def _skill_files(spark, d):
    p = Tables(spark, d).part
    nl = F.when(F.col("p_size") > 40, F.lit("\r\n")).otherwise(F.lit("\n"))
    name = F.when(F.col("p_size") < 5, F.col("p_name")).otherwise(F.regexp_replace("p_name", " ", "-"))
    text = F.concat(F.lit("---"), nl, F.lit("name: "), name, nl, F.lit("# note"), nl, F.lit("description: "),
                    F.col("p_type"), nl, F.lit("allowed-tools: search  sql"), nl, F.lit("---"), nl,
                    F.lit("Body of "), F.col("p_partkey").cast("string"))
    return p.select(F.col("p_partkey").alias("path"), text.alias("text"))


@query("frontmatter_scan", r"""
WITH src AS (SELECT p_partkey AS path, CASE WHEN p_size > 40 THEN E'
' ELSE E'
' END AS nl,
    CASE WHEN p_size < 5 THEN p_name ELSE replace(p_name, ' ', '-') END AS nm, p_type FROM part),
t AS (SELECT path, '---' || nl || 'name: ' || nm || nl || '# note' || nl || 'description: ' || p_type || nl ||
    'allowed-tools: search  sql' || nl || '---' || nl || 'Body of ' || CAST(path AS VARCHAR) AS text FROM src),
f AS (SELECT path, regexp_matches(text, '^---
?
([\s\S]*?)
?
---
?
?([\s\S]*)$') AS has,
    regexp_extract(text, '^---
?
([\s\S]*?)
?
---
?
?([\s\S]*)$', 1) AS front,
    regexp_extract(text, '^---
?
([\s\S]*?)
?
---
?
?([\s\S]*)$', 2) AS body FROM t),
kv AS (SELECT *, list_transform(list_filter(list_transform(regexp_split_to_array(front, '
?
'), lambda l: trim(l)),
    lambda l: l <> '' AND NOT starts_with(l, '#') AND contains(l, ':')),
    lambda l: {'k': trim(split_part(l, ':', 1)), 'v': trim(substr(l, strpos(l, ':') + 1))}) AS kv FROM f),
v AS (SELECT path, body, has, trim(coalesce(list_filter(kv, lambda x: x.k = 'name')[-1].v, '')) AS name,
    trim(coalesce(list_filter(kv, lambda x: x.k = 'description')[-1].v, '')) AS description,
    list_filter(regexp_split_to_array(list_filter(kv, lambda x: x.k = 'allowed-tools')[-1].v, '\s+'), lambda x: x <> '') AS tools FROM kv),
c AS (SELECT name, count(*) AS n FROM v GROUP BY name)
SELECT v.path, v.name, v.description, array_to_string(v.tools, ',') AS allowed_tools,
  CAST((CASE WHEN NOT v.has THEN 1 ELSE 0 END) + (CASE WHEN length(v.name) < 1 OR length(v.name) > 64 THEN 1 ELSE 0 END)
    + (CASE WHEN NOT regexp_matches(v.name, '^[a-z0-9]+(?:-[a-z0-9]+)*$') THEN 1 ELSE 0 END)
    + (CASE WHEN length(v.description) < 1 OR length(v.description) > 1024 THEN 1 ELSE 0 END) AS INTEGER) AS n_errors,
  c.n > 1 AND v.name <> '' AS duplicate_name, v.body
FROM v JOIN c ON v.name = c.name
""")
def frontmatter_scan(spark, d):
    s = S.scan_frontmatter(_skill_files(spark, d))
    return s.select("path", "name", "description", F.array_join("allowed_tools", ",").alias("allowed_tools"),
                    F.size("errors").alias("n_errors"), "duplicate_name", "body")


# ------------------------------------------------------------ run and agent logs


def _run_logs(spark, d):
    e = Tables(spark, d).events
    ev = (F.when(F.col("event_type") == "view", "started").when(F.col("event_type").isin("click", "purchase"), "completed")
          .when(F.col("event_type") == "error", "failed").otherwise("skipped"))
    return e.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("run_id"),
                    F.col("event_id").alias("seq"), F.col("event_type").alias("block_id"), ev.alias("event"),
                    (F.col("value") * 1000).cast("long").alias("duration_ms"), F.col("ts").alias("created_at"))


@query("run_log_rollup", """
SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS block_id,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS started,
  CAST(sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS BIGINT) AS completed,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS skipped,
  CAST(0 AS BIGINT) AS timeout, CAST(sum(CAST(trunc(value * 1000) AS BIGINT)) AS BIGINT) AS total_ms,
  CAST(max(CAST(trunc(value * 1000) AS BIGINT)) AS BIGINT) AS max_ms
FROM events GROUP BY user_id, event_type
""")
def run_log_rollup(spark, d):
    return A.run_rollup(_run_logs(spark, d))


@query("agent_run_stats", """
SELECT o_orderpriority AS agent_id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
  count(*) AS runs, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT) AS tokens, round(avg(o_custkey * 10), 4) AS avg_ms,
  CAST(max(o_custkey * 10) AS BIGINT) AS max_ms
FROM orders GROUP BY 1, 2
""")
def agent_run_stats(spark, d):
    o = Tables(spark, d).orders
    runs = o.select(F.col("o_orderpriority").alias("agent_id"), F.when(F.col("o_orderstatus") == "F", "completed")
                    .when(F.col("o_orderstatus") == "O", "running").otherwise("failed").alias("status"),
                    F.col("o_totalprice").cast("long").alias("tokens_used"), (F.col("o_custkey") * 10).alias("duration_ms"))
    return A.agent_stats(runs)


def _agent_log(spark, d):
    e = Tables(spark, d).events
    t = (F.when(F.col("event_type") == "signup", "agent_start").when(F.col("event_type") == "view", "turn_start")
         .when(F.col("event_type") == "click", "tool_call").when(F.col("event_type") == "error", "tool_error")
         .otherwise("agent_end"))
    return e.select(F.col("user_id").cast("string").alias("run_id"), t.alias("type"), "ts")


@query("agent_event_stats", """
SELECT CAST(user_id AS VARCHAR) AS run_id,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS turns,
  CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS tool_calls,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS tool_errors,
  CAST(0 AS BIGINT) AS violations,
  round((epoch_us(max(CASE WHEN event_type = 'purchase' THEN ts END)) - epoch_us(min(CASE WHEN event_type = 'signup' THEN ts END))) / 1e6, 3) AS duration_s
FROM events GROUP BY user_id
""")
def agent_event_stats(spark, d):
    return A.event_stats(_agent_log(spark, d))


def _tool_calls(spark, d):
    e = Tables(spark, d).events.filter(F.col("event_type") == "click")
    return e.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("call_id"), "ts",
                    F.when(F.col("value") > 25, "web").otherwise("search").alias("tool"))


@query("call_limits", """
WITH c AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS call_id, ts,
    CASE WHEN value > 25 THEN 'web' ELSE 'search' END AS tool FROM events WHERE event_type = 'click'),
s AS (SELECT *, count(*) OVER (PARTITION BY run_id, tool ORDER BY ts, call_id ROWS UNBOUNDED PRECEDING) AS tool_seq,
        count(*) OVER (PARTITION BY run_id ORDER BY ts, call_id ROWS UNBOUNDED PRECEDING) AS run_seq FROM c)
SELECT run_id, call_id, tool, tool_seq, run_seq,
  CASE WHEN tool = 'web' AND tool_seq > 3 THEN 'tool limit 3 reached for web' ELSE 'max_tool_calls 10 reached' END AS violation
FROM s WHERE (tool = 'web' AND tool_seq > 3) OR run_seq > 10
""")
def call_limits(spark, d):
    v = LG.audit_call_limits(_tool_calls(spark, d), {"web": 3}, max_tool_calls=10)
    return v.select("run_id", "call_id", "tool", "tool_seq", "run_seq", "violation")


@query("tool_timeouts", """
WITH ev AS (SELECT CAST(user_id AS VARCHAR) AS run_id,
    CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS VARCHAR) AS call_id,
    event_type, ts FROM events WHERE event_type IN ('click', 'view')),
c AS (SELECT run_id, call_id, ts AS call_ts FROM ev WHERE event_type = 'click'),
r AS (SELECT run_id, call_id, ts AS result_ts FROM ev WHERE event_type = 'view'),
p AS (SELECT c.run_id, c.call_id, c.call_ts, r.result_ts, (epoch_us(r.result_ts) - epoch_us(c.call_ts)) / 1e6 AS dur
      FROM c LEFT JOIN r ON c.run_id = r.run_id AND c.call_id = r.call_id)
SELECT run_id, call_id, CASE WHEN result_ts IS NULL THEN 'no result' ELSE 'timeout' END AS reason
FROM p WHERE result_ts IS NULL OR dur > 30
""")
def tool_timeouts(spark, d):
    from tessera.queries.joins_graph import _agent_events

    p = J.pair_calls(_agent_events(spark, d))
    return LG.audit_timeouts(p, 30).select("run_id", "call_id", "reason")


# --------------------------------------------------------- memory and windows


@query("memory_window", """
WITH c AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM c WHERE role <> 'system')
SELECT conv_id, turn, role FROM c WHERE role = 'system'
UNION ALL SELECT conv_id, turn, role FROM o WHERE n <= 4 OR rn <= greatest(4 - s, 0)
""")
def memory_window(spark, d):
    return LG.memory_window(Tables(spark, d).conversations, 4).select("conv_id", "turn", "role")


@query("memory_clear", "SELECT conv_id, turn, role FROM conversations WHERE role = 'system'")
def memory_clear(spark, d):
    return LG.memory_clear(Tables(spark, d).conversations).select("conv_id", "turn", "role")


@query("loop_items", """
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS "index", w[i] AS item, CAST(len(w) AS INTEGER) AS total, i = len(w) AS is_last
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)
""")
def loop_items(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.split("p_name", " ").alias("words"))
    it = O.iterate(p, "words", 100)
    return it.select("p_partkey", "index", "item", "total", "is_last")


@query("loop_batches", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((rn - 1) // 3 AS BIGINT) AS batch_no, CAST((rn - 1) % 3 AS BIGINT) AS pos_in_batch FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
""")
def loop_batches(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                          "l_extendedprice")
    # (order, line number) is not unique in this data: the order ends in all line columns
    b = O.batch(li, 3, ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], ["l_orderkey"])
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "batch_no", "pos_in_batch")


@query("truncate_payload", """
SELECT doc_id, CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || E'\\n...[truncated from ' || CAST(length(text) AS VARCHAR) || ' to 8000 chars]'
  ELSE text END AS text FROM documents
""")
def truncate_payload(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    return O.truncate_text(docs, "text", 8000, "\n...[truncated from {total} to {kept} chars]")


# ------------------------------------------------------- search-time filters


def _meta_docs(spark, d):
    docs = Tables(spark, d).documents
    meta = F.create_map(F.lit("lang"), F.upper("lang"), F.lit("source"), F.col("source"),
                        F.lit("n_chars"), F.col("n_chars").cast("string"))
    return docs.select("doc_id", meta.alias("metadata"))


def _meta(key, spec, sql_where):
    @query(key, f"SELECT doc_id FROM documents WHERE {sql_where}")
    def run(spark, d):
        return FL.metadata_filter(_meta_docs(spark, d), spec).select("doc_id")
    return run


_meta("meta_scalar", {"lang": "en"}, "lang = 'en'")
_meta("meta_eq", {"source": {"$eq": "SRC3"}}, "source = 'src3'")
_meta("meta_ne", {"lang": {"$ne": "EN"}}, "lang <> 'en'")
_meta("meta_like", {"source": {"$like": "SRC1_"}}, "source ILIKE 'src1_'")
_meta("meta_prefix", {"source": {"$prefix": "Src1"}}, "starts_with(source, 'src1')")
_meta("meta_in", {"lang": {"$in": ["de", "ES"]}}, "lang IN ('de', 'es')")
_meta("meta_range", {"n_chars": {"$gte": 5000}}, "n_chars >= 5000")
_meta("meta_exists", {"missing_key": {"$exists": False}}, "true")


_EVT = "SELECT event_id, user_id, ts FROM events"


@query("temporal_before", f"{_EVT} WHERE ts < TIMESTAMP '2024-01-10 00:00:00'")
def temporal_before(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return FL.temporal_filter(e, "before", "ts", end=F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))


@query("temporal_after", f"{_EVT} WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def temporal_after(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return FL.temporal_filter(e, "after", "ts", start=F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


@query("temporal_between", f"{_EVT} WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'")
def temporal_between(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return FL.temporal_filter(e, "between", "ts", start=F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"),
                              end=F.lit("2024-01-12 00:00:00").cast("timestamp_ntz"))


@query("temporal_as_of", """
SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1
""")
def temporal_as_of(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return FL.temporal_filter(e, "as_of", "ts", entity="user_id", as_of=F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))


@query("temporal_latest", """
SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def temporal_latest(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return FL.temporal_filter(e, "latest", "ts", entity="user_id")


@query("compound_filter", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_returnflag = 'R' AND (l_quantity >= 45 OR l_discount < 0.01 OR l_linestatus IN ('X'))
""")
def compound_filter(spark, d):
    tree = {"type": "and", "filters": [
        {"type": "eq", "key": "l_returnflag", "value": "R"},
        {"type": "or", "filters": [{"type": "gte", "key": "l_quantity", "value": 45},
                                   {"type": "lt", "key": "l_discount", "value": 0.01},
                                   {"type": "in", "key": "l_linestatus", "value": ["X"]}]}]}
    return FL.compound_filter(Tables(spark, d).lineitem, tree).select("l_orderkey", "l_linenumber")


@query("min_score", "SELECT o_orderkey, o_totalprice AS score FROM orders WHERE o_totalprice >= 300000")
def min_score(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.col("o_totalprice").alias("score"))
    return FL.min_score(o, 300000)


@query("job_filter", """
SELECT o_orderkey AS id, o_custkey AS org_id, o_orderpriority AS bucket_id, o_orderstatus AS status FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' ORDER BY id LIMIT 20
""")
def job_filter(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("org_id"),
                                        F.col("o_orderpriority").alias("bucket_id"), F.col("o_orderstatus").alias("status"))
    return FL.job_filter(o, bucket="1-URGENT", status="F", limit=20)


@query("after_seq", "SELECT event_id AS seq, event_type FROM events WHERE event_id > 5000")
def after_seq(spark, d):
    e = Tables(spark, d).events.select(F.col("event_id").alias("seq"), "event_type")
    return FL.after_seq(e, 5000)


@query("expire_rows", """
SELECT o_custkey, last_active_at FROM (SELECT o_custkey, max(o_orderdate) AS last_active_at FROM orders GROUP BY o_custkey)
WHERE last_active_at >= TIMESTAMP '1998-08-01 00:00:00' - INTERVAL 365 DAY
""")
def expire_rows(spark, d):
    o = Tables(spark, d).orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_active_at"))
    return FL.expire_rows(o, 365, F.lit("1998-08-01 00:00:00").cast("timestamp_ntz"))


# ------------------------------------------------------------ aggregates


@query("metadata_group_count", """
SELECT source AS value, count(*) AS count, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM documents WHERE lang = 'en' GROUP BY source
""")
def metadata_group_count(spark, d):
    docs = Tables(spark, d).documents
    m = docs.select(F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("metadata"))
    return A.group_count(m, "source", "lang", "en", meta_col="metadata")


@query("facets", """
WITH p AS (SELECT 'lang' AS field, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents),
c AS (SELECT field, value, count(*) AS count FROM p GROUP BY field, value)
SELECT field, value, count, total, rank FROM (SELECT *, CAST(sum(count) OVER (PARTITION BY field) AS BIGINT) AS total,
  row_number() OVER (PARTITION BY field ORDER BY count DESC, value) AS rank FROM c) WHERE rank <= 5
""")
def facets(spark, d):
    return A.facets(Tables(spark, d).documents, ["lang", "source"], limit=5)


@query("collection_stats", """
SELECT lang AS collection, count(DISTINCT doc_id) AS files, sum(len(generate_series(0, greatest(length(text) - 50 - 1, 0), 462))) AS vectors,
  CAST(0 AS BIGINT) AS active_jobs FROM documents GROUP BY lang
""")
def collection_stats(spark, d):
    docs = Tables(spark, d).documents
    ch = TX.chunk_fixed(docs, "text", 512, 50).join(docs.select("doc_id", F.col("lang").alias("collection")), "doc_id")
    s = A.collection_stats(ch.withColumnRenamed("doc_id", "document_id"))
    return s.select("collection", "files", F.col("vectors").cast("long").alias("vectors"), "active_jobs")


@query("job_progress", """
SELECT d.lang AS job_id, count(*) AS total, CAST(sum(CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS projected,
  round(sum(CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END) / count(*), 4) AS progress,
  CASE WHEN sum(CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END) = count(*) THEN 'completed'
       WHEN sum(CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END) = 0 THEN 'pending' ELSE 'running' END AS state
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang
""")
def job_progress(spark, d):
    t = Tables(spark, d)
    docs = t.documents.join(t.labels.select("doc_id", F.lit(True).alias("projected")), "doc_id", "left")
    j = docs.select(F.col("lang").alias("job_id"), F.coalesce("projected", F.lit(False)).alias("projected"))
    p = A.job_progress(j)
    return p.select("job_id", "total", F.col("projected").cast("long").alias("projected"), "progress", "state")


# ------------------------------------------------------------------ flows


@query("scheduled_sync", """
SELECT l_linestatus, count(*) AS count_items, round(sum(l_quantity), 2) AS sum_l_quantity FROM lineitem
WHERE l_returnflag = 'N' AND l_quantity >= 10 GROUP BY l_linestatus
""")
def scheduled_sync(spark, d):
    s = X.scheduled_sync(Tables(spark, d).lineitem, [("source", "string", "batch")],
                         [("l_returnflag", "equals", "N"), ("l_quantity", "gte", 10), ("source", "equals", "batch")],
                         "l_linestatus", [("count", ""), ("sum", "l_quantity")])
    return s.select("l_linestatus", "count_items", F.round("sum_l_quantity", 2).alias("sum_l_quantity"))


@query("branch_merge_flow", """
SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'true' ELSE 'false' END AS branch,
  CASE WHEN o_totalprice > 200000 THEN 'vip' ELSE 'std' END AS tier,
  CASE WHEN o_totalprice > 200000 THEN 0 ELSE 1 END AS source_no FROM orders
""")
def branch_merge_flow(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    out = X.branch_flow(o, "o_totalprice", "gt", 200000,
                        lambda t: t.withColumn("tier", F.lit("vip")), lambda f: f.withColumn("tier", F.lit("std")))
    return out.select("o_orderkey", "branch", "tier", "source_no")


_SW_RULES = [
    {"output": "bulk", "conditions": [("l_quantity", "gte", 40)]},
    {"output": "returned", "conditions": [("l_returnflag", "equals", "R")]},
    {"output": "open", "conditions": [("l_linestatus", "equals", "O")]},
]


@query("switch_flow", """
SELECT l_orderkey, l_linenumber, output, CASE output WHEN 'bulk' THEN 'freight' WHEN 'returned' THEN 'refund'
  WHEN 'open' THEN 'ship' ELSE 'archive' END AS action FROM (
  SELECT *, CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_returnflag = 'R' THEN 'returned' WHEN l_linestatus = 'O' THEN 'open'
    ELSE 'default' END AS output FROM lineitem)
""")
def switch_flow(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    acts = {"bulk": "freight", "returned": "refund", "open": "ship", "default": "archive"}
    fns = {k: (lambda v: (lambda x: x.withColumn("action", F.lit(v))))(v) for k, v in acts.items()}
    return X.switch_flow(li, _SW_RULES, fns).select("l_orderkey", "l_linenumber", "output", "action")


#: chunks of documents of which every tenth was stored again, shorter
_REINGEST_SQL = """
v AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN substr(text, 1, 300) ELSE text END AS text FROM documents),
c AS (SELECT doc_id, s, text FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 50 - 1, 0), 462)) AS s FROM v))"""


def _shorter(docs):
    return docs.filter(F.col("doc_id") % 10 == 0).withColumn("text", F.substring("text", 1, 300))


@query("rag_ingest", f"""
WITH {_REINGEST_SQL}
SELECT doc_id || ':' || CAST(s / 462 AS INTEGER) AS id, CAST(doc_id AS VARCHAR) AS document_id, CAST(s / 462 AS INTEGER) AS chunk_no,
  md5(substr(text, s + 1, 512)) AS text_md5, 'default' AS bucket, 'main' AS collection, 'docs' AS team, 64 AS dims FROM c
""")
def rag_ingest(spark, d):
    docs = Tables(spark, d).documents
    t = VersionedTable.create(spark, ST.scratch_path(spark, "chunks"), X.CHUNK_SCHEMA, "document_id")
    for part in (docs, _shorter(docs)):
        t.upsert(X.rag_ingest(part, "main", 512, 50, 64, metadata={"team": "docs"}))
    return t.read().select("id", "document_id", "chunk_no", F.md5("text").alias("text_md5"), "bucket", "collection",
                           F.col("metadata")["team"].alias("team"), F.size("embedding").alias("dims"))


@query("rag_context", None)
def rag_context(spark, d):
    t = Tables(spark, d)
    return X.rag_context(t.benchmark.withColumnRenamed("item_id", "query_id"), t.documents, k=3)


@query("multi_source_context", None)
def multi_source_context(spark, d):
    t = Tables(spark, d)
    docs = t.documents
    corpora = {"en": docs.filter(F.col("lang") == "en"), "other": docs.filter(F.col("lang") != "en")}
    return X.multi_source_context(t.benchmark.withColumnRenamed("item_id", "query_id"), corpora, k=3)


def _context(spark, d, mode, budget):
    from tessera.queries.docs_search import _grants

    t = Tables(spark, d)
    docs = t.documents.select("doc_id", "text", F.col("lang").alias("collection"),
                              F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("metadata"))
    q = t.benchmark.withColumnRenamed("item_id", "query_id")
    x = X.bucket_context(q, docs, _grants(spark), roles=["support"], budget=budget, k=10,
                         filters={"source": {"$prefix": "src"}}, sessions=t.conversations, n_turns=2, mode=mode)
    chunk = lambda c: F.concat_ws("|", c["id"], F.md5(c["text"]), F.floor(c["score"] * 1e6).cast("string"), c["metadata"]["lang"], c["metadata"]["source"])
    return x.select("query_id", "context", "tokens_used", F.array_join(F.transform("chunks", chunk), ",").alias("chunks"),
                    F.array_join(F.transform("session_turns", lambda t: F.concat_ws("=", t["role"], t["content"])), "&").alias("session_turns"),
                    "n_included", "n_truncated", "n_skipped", "mode_used")


_CONTEXT_CORPUS_SQL = "corpus AS (SELECT doc_id, text, lang, source FROM documents WHERE lang IN ('en', 'fr') AND source LIKE 'src%')"


def _context_sql(hits, mode, budget):
    """Twin of the context flow over ranked ``hits (query_id, id, score, rank)``."""
    pack = D._PACK_SQL.replace("2000", f"({budget} - spent)").replace("SELECT query_id, rank, mark, mark ||", "SELECT query_id, rank, mark, spent, mark ||")
    return f"""
WITH {_CONTEXT_CORPUS_SQL}, {hits},
t AS (SELECT conv_id, role, text, role || ': ' || text AS line, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations),
f AS (SELECT *, CAST(ceil((sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY rn ROWS UNBOUNDED PRECEDING) + 1) / 4.0) AS BIGINT) AS spent FROM t WHERE rn <= 2),
turns AS (SELECT conv_id, max(spent) AS spent, string_agg(line, chr(10) ORDER BY rn DESC) AS turns_text, string_agg(role || '=' || text, '&' ORDER BY rn DESC) AS st
  FROM f WHERE spent <= {budget} GROUP BY conv_id),
m AS (SELECT hits.query_id, rank, {D._MARK_SQL} AS mark, '[' || source || ':' || id || '] ' || text AS text, coalesce(turns.spent, 0) AS spent
  FROM hits JOIN corpus ON doc_id = id LEFT JOIN turns ON turns.conv_id = hits.query_id),
packed AS (WITH {pack}),
ch AS (SELECT query_id, string_agg(concat_ws('|', CAST(id AS VARCHAR), md5(text), CAST(CAST(floor(score * 1e6) AS BIGINT) AS VARCHAR), lang, source), ',' ORDER BY rank) AS chunks
  FROM hits JOIN corpus ON doc_id = id GROUP BY query_id)
SELECT item_id AS query_id, CASE WHEN coalesce(packed.context, '') = '' THEN coalesce(turns_text, '') WHEN turns_text IS NULL THEN packed.context
    ELSE turns_text || chr(10) || chr(10) || packed.context END AS context,
  CAST(coalesce(tokens_used, 0) + coalesce(turns.spent, 0) AS BIGINT) AS tokens_used, coalesce(chunks, '') AS chunks, coalesce(st, '') AS session_turns,
  coalesce(n_included, 0) AS n_included, coalesce(n_truncated, 0) AS n_truncated, coalesce(n_skipped, 0) AS n_skipped, '{mode}' AS mode_used
FROM benchmark LEFT JOIN packed ON packed.query_id = item_id LEFT JOIN ch ON ch.query_id = item_id LEFT JOIN turns ON turns.conv_id = item_id
"""


_CONTEXT_BM25 = D._BM25_SQL.replace("FROM documents", "FROM corpus").strip()

query("bucket_context", _context_sql(f"""{_CONTEXT_BM25}, {D._COS_SQL.replace("FROM documents", "FROM corpus")},
vec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM cos) WHERE rank <= 10),
fused AS (SELECT query_id, id, coalesce(1.0::DOUBLE / (60 + bm.rank), 0) + coalesce(1.0::DOUBLE / (60 + vec.rank), 0) AS score
  FROM bm FULL JOIN vec USING (query_id, id)),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fused) WHERE rank <= 10)""", "auto", 2000))(
    lambda spark, d: _context(spark, d, "auto", 2000))

# words alone, and a budget that the turns use up first
query("bucket_context_naive", _context_sql(f"{_CONTEXT_BM25}, hits AS (SELECT query_id, id, round(score, 9) AS score, rank FROM bm)", "naive", 300))(
    lambda spark, d: _context(spark, d, "naive", 300))


@query("route_intent", f"""
WITH routes AS (SELECT * FROM (VALUES ('billing', 'invoice payment refund charge price order'),
  ('tech', 'error bug crash code install server'), ('other', 'hello thanks question general')) t(label, text)),
conv AS (SELECT conv_id || ':' || turn AS cid, conv_id, turn, text FROM conversations),
{D._emb_sql('r', 'routes', 'label')},{D._emb_sql('c', 'conv', 'cid')},
nr AS (SELECT id, sqrt(sum(x * x)) AS n FROM rv GROUP BY id), nc AS (SELECT id, sqrt(sum(x * x)) AS n FROM cv GROUP BY id),
dots AS (SELECT cv.id AS cid, rv.id AS label, sum(cv.x * rv.x) AS dot FROM cv JOIN rv USING (dim) GROUP BY ALL),
s AS (SELECT conv_id, turn, routes.label, coalesce(dot / (nr.n * nc.n), 0) AS score FROM conv CROSS JOIN routes
  LEFT JOIN dots ON dots.cid = conv.cid AND dots.label = routes.label
  LEFT JOIN nr ON nr.id = routes.label LEFT JOIN nc ON nc.id = conv.cid)
SELECT conv_id, turn, CASE WHEN score > 0 THEN label ELSE 'default' END AS route, round(score, 6) AS confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, label DESC) AS rn FROM s) WHERE rn = 1
""")
def route_intent(spark, d):
    routes = [{"name": "billing", "description": "invoice payment refund charge price order"},
              {"name": "tech", "description": "error bug crash code install server"},
              {"name": "other", "description": "hello thanks question general"}]
    return X.route_by_similarity(Tables(spark, d).conversations.select("conv_id", "turn", "text"), routes).select(
        "conv_id", "turn", "route", "confidence")


# ---------------------------------------------------------------- sources


@query("ingest_upload", """
SELECT doc_id, 'docs' AS bucket, lang AS collection, '18' AS week, 'growth' AS team, source FROM documents
""")
def ingest_upload(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "lang", F.create_map(F.lit("source"), F.col("source"),
                                                                             F.lit("team"), F.lit("old")).alias("metadata"))
    # one scan: the collection is a column; written by bucket and collection, and read back
    path = ST.scratch_path(spark, "uploads")
    S.write_collection(S.ingest_upload(docs, "docs", F.col("lang"), {"week": 18, "team": "growth"}), path)
    u = spark.read.parquet(path)
    return u.select("doc_id", "bucket", "collection", F.col("metadata")["week"].alias("week"),
                    F.col("metadata")["team"].alias("team"), F.col("metadata")["source"].alias("source"))


@query("validate_metadata", """
WITH m AS (SELECT doc_id, CASE WHEN lang = 'de' THEN MAP {'text': source} WHEN lang = 'es' THEN MAP {'bad key': source}
    ELSE MAP {'source': source} END AS m FROM documents),
e AS (SELECT doc_id, list_filter([
    CASE WHEN len(map_keys(m)) > 32 THEN 'more than 32 keys' END,
    CASE WHEN list_bool_or(list_transform(map_keys(m), lambda k: NOT regexp_full_match(k, '[A-Za-z0-9_.-]+'))) THEN 'bad key characters' END,
    CASE WHEN list_bool_or(list_transform(map_keys(m), lambda k: length(k) > 64)) THEN 'key longer than 64' END,
    CASE WHEN list_bool_or(list_transform(map_values(m), lambda x: length(x) > 512)) THEN 'value longer than 512' END,
    CASE WHEN strlen(CAST(to_json(m) AS VARCHAR)) > 4096 THEN 'JSON above 4096 bytes' END,
    CASE WHEN list_bool_or(list_transform(map_keys(m), lambda k: k IN ('document_id', 'chunk_id', 'bucket_id', 'text'))) THEN 'reserved key' END],
    lambda x: x IS NOT NULL) AS errs FROM m)
SELECT doc_id, array_to_string(errs, ',') AS errors, len(errs) = 0 AS valid FROM e
""")
def validate_metadata(spark, d):
    docs = Tables(spark, d).documents
    m = (F.when(F.col("lang") == "de", F.create_map(F.lit("text"), F.col("source")))
         .when(F.col("lang") == "es", F.create_map(F.lit("bad key"), F.col("source")))
         .otherwise(F.create_map(F.lit("source"), F.col("source"))))
    v = S.validate_metadata(docs.select("doc_id", m.alias("metadata")))
    return v.select("doc_id", F.array_join("errors", ",").alias("errors"), "valid")


#: the whole vector as text: components in ten-thousandths
_VECTOR_SQL = "array_to_string(list_transform({0}, lambda x: CAST(floor(CAST(x AS DOUBLE) * 10000) AS BIGINT)), ',')"


def _vector_text(c):
    return F.array_join(F.transform(c, lambda x: F.floor(x.cast("double") * 10000).cast("string")), ",")


def _vector_table(spark, rows):
    t = VersionedTable.create(spark, ST.scratch_path(spark, "vectors"), "vec_id long, embedding array<float>, label int, version int", "vec_id")
    t.append(rows)
    return t


@query("upsert_vectors", f"""
SELECT vec_id, CASE WHEN label = 0 THEN 2 ELSE 1 END AS version, label,
  {_VECTOR_SQL.format("CASE WHEN label = 0 THEN list_reverse(embedding) ELSE embedding END")} AS vector FROM embeddings
""")
def upsert_vectors(spark, d):
    e = Tables(spark, d).embeddings
    t = _vector_table(spark, e.select("vec_id", "embedding", "label", F.lit(1).alias("version")))
    updates = e.filter(F.col("label") == 0).select("vec_id", F.reverse("embedding").alias("embedding"), "label",
                                                   F.lit(2).alias("version"))
    stale = e.filter(F.col("label") == 1).select("vec_id", F.reverse("embedding").alias("embedding"), "label", F.lit(0).alias("version"))
    t.upsert(updates.unionByName(stale), version_col="version")
    return t.read().select("vec_id", "version", "label", _vector_text("embedding").alias("vector"))


@query("delete_vectors", f"SELECT vec_id, {_VECTOR_SQL.format('embedding')} AS vector FROM embeddings WHERE label <> 9")
def delete_vectors(spark, d):
    e = Tables(spark, d).embeddings
    t = _vector_table(spark, e.withColumn("version", F.lit(1)))
    t.delete(e.filter(F.col("label") == 9).select("vec_id"))
    return t.read().select("vec_id", _vector_text("embedding").alias("vector"))


@query("vector_import", f"""
SELECT list_value('pgvector', 'pinecone', 'weaviate', 'chroma')[vec_id % 4 + 1] AS layout, 'v' || vec_id AS id,
  {_VECTOR_SQL.format('embedding')} AS vector, CAST(label AS VARCHAR) AS label, NULL AS error FROM embeddings
UNION ALL
SELECT list_value('pgvector', 'pinecone', 'weaviate', 'chroma')[vec_id % 4 + 1], CASE WHEN vec_id % 4 = 0 THEN 'broken' END, NULL, NULL,
  CASE WHEN vec_id % 4 = 0 THEN 'no vector of numbers' ELSE 'no id' END FROM embeddings WHERE vec_id % 50 < 4
""")
def vector_import(spark, d):
    # a quarter of the vectors in each layout, and a broken line after some of them
    e = Tables(spark, d).embeddings
    key, label = F.concat(F.lit("v"), "vec_id"), F.create_map(F.lit("label"), F.col("label").cast("string"))
    v = F.transform("embedding", lambda x: x.cast("double"))
    line = {
        "pgvector": F.concat_ws("\t", key, F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]")), F.to_json(label)),
        "pinecone": F.to_json(F.struct(key.alias("id"), v.alias("values"), label.alias("metadata"))),
        "weaviate": F.to_json(F.struct(key.alias("id"), F.lit("Doc").alias("class"), v.alias("vector"), label.alias("properties"))),
        "chroma": F.to_json(F.struct(F.array(key).alias("ids"), F.array(v).alias("embeddings"), F.array(label).alias("metadatas"))),
    }
    out = None
    for i, layout in enumerate(S.LAYOUTS):
        path = ST.scratch_path(spark, layout)
        own = e.filter(F.col("vec_id") % 4 == i)
        broken = F.lit("broken\t[1,x]") if layout == "pgvector" else F.lit('{"id": ')
        own.select(F.explode(F.when(F.col("vec_id") % 50 < 4, F.array(line[layout], broken)).otherwise(F.array(line[layout]))).alias("value")).write.text(path)
        part = S.import_vectors(spark, path, layout).select(F.lit(layout).alias("layout"), "id", _vector_text("vector").alias("vector"), F.col("metadata")["label"].alias("label"), "error")
        out = part if out is None else out.unionByName(part)
    return out


def export_answers(spark, d):
    from tessera.queries.shapes import format_answer

    a = format_answer(spark, d)
    out = None
    for form in ("json", "markdown", "text"):
        path = ST.scratch_path(spark, f"answers-{form}")
        S.export_answers(a, path, form, id_col="s_suppkey")
        back = S.read_answers(spark, path, form)
        key = F.col("id").cast("long") if "id" in back.columns else F.col("s_suppkey") if "s_suppkey" in back.columns else F.lit(None).cast("long")
        part = back.select(F.lit(form).alias("form"), key.alias("s_suppkey"), "answer")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- streams


def _events_stream(spark, d):
    schema = Tables(spark, d).events.schema
    return spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")


@query("stream_filter_route", """
SELECT event_id, CASE WHEN value > 40 THEN 'high' ELSE 'default' END AS output FROM events WHERE event_type IN ('click', 'view')
""")
def stream_filter_route(spark, d):
    s = ST.stream_filter_route(_events_stream(spark, d), conditions=[("event_type", "equals", "click"), ("event_type", "equals", "view")],
                               rules=[{"output": "high", "conditions": [("value", "gt", 40)]}], combinator="or")
    return ST.run_available(s.select("event_id", "output"), "filter-route")


@query("stream_usage", f"""
SELECT org_id, time_bucket(INTERVAL 1 MINUTE, ts) AS minute, count(*) AS call_count,
  CAST(sum(llm_input_tokens) AS BIGINT) AS llm_input_tokens, CAST(sum(llm_output_tokens) AS BIGINT) AS llm_output_tokens,
  CAST(sum(embed_tokens) AS BIGINT) AS embed_tokens
FROM ({_FIELDS_SQL}) GROUP BY org_id, time_bucket(INTERVAL 1 MINUTE, ts)
""")
def stream_usage(spark, d):
    s = _events_stream(spark, d)
    k = F.get_json_object("props", "$.k")
    body = (F.when(F.col("event_type") == "click", F.concat(
        F.lit('{"usage": {"prompt_tokens": '), k, F.lit(', "completion_tokens": '), (k.cast("int") % 7).cast("string"), F.lit("}}")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"usage": {"input_tokens": '), k, F.lit(', "output_tokens": 3}}')))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"usage": {"total_tokens": '), k, F.lit("}}")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"usage": {"prompt_tokens": "'), k, F.lit('"}}')))
        .otherwise(F.concat(F.lit("["), k, F.lit("]"))))
    b = s.select("ts", F.col("user_id").alias("org_id"), body.alias("body"))
    # a delay longer than the month of data: nothing is late in this check
    agg = ST.stream_usage(b, delay="40 days")
    out = ST.run_available(agg, "usage", keys=["org_id", "minute"], mode="update")
    return out.select("org_id", F.col("minute").cast("timestamp_ntz").alias("minute"), "call_count",
                      "llm_input_tokens", "llm_output_tokens", "embed_tokens")


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    s = _events_stream(spark, d).select("user_id", "event_type", "ts")
    # the delay covers the month of data: each key is kept once
    dd = ST.stream_dedupe(s, ["user_id", "event_type"], "ts", "40 days")
    return ST.run_available(dd, "dedupe").select("user_id", "event_type")


@query("stream_pair_calls", """
WITH ev AS (SELECT CAST(user_id AS VARCHAR) AS run_id,
    CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS VARCHAR) AS call_id,
    event_type, ts, props FROM events WHERE event_type IN ('click', 'view')),
c AS (SELECT run_id, call_id, 'search' AS tool, ts AS call_ts FROM ev WHERE event_type = 'click'),
r AS (SELECT run_id, call_id, ts AS result_ts, props AS result FROM ev WHERE event_type = 'view')
SELECT coalesce(c.run_id, r.run_id) AS run_id, coalesce(c.call_id, r.call_id) AS call_id, c.tool, c.call_ts, r.result_ts, r.result,
  round((epoch_us(r.result_ts) - epoch_us(c.call_ts)) / 1e6, 6) AS duration_s
FROM c FULL OUTER JOIN r ON c.run_id = r.run_id AND c.call_id = r.call_id AND r.result_ts BETWEEN c.call_ts AND c.call_ts + INTERVAL 36 HOUR
""")
def stream_pair_calls(spark, d):
    from tessera.queries.joins_graph import _agent_events

    landing = ST.scratch_path(spark, "calls")
    log = _agent_events(spark, d)
    log.repartition(3, "call_id").write.parquet(landing)  # three files land, one is taken at a time
    s = ST.landing_stream(spark, landing, log.schema, "parquet", max_files=1)
    calls = s.filter(F.col("type") == "tool_call").select("run_id", "call_id", "ts", F.col("tool_name").alias("tool"))
    results = s.filter(F.col("type") == "tool_result").select("run_id", "call_id", "ts", "result")
    # the delay covers the month of data: files are dealt by call, not by time
    p = ST.pair_calls_now(calls, results, "36 hours", "40 days")
    wall = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return p.select("run_id", "call_id", "tool", wall("call_ts"), wall("result_ts"), "result", "duration_s")


@query("stream_memory", """
WITH c AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM c WHERE role <> 'system')
SELECT conv_id, turn, role, text FROM c WHERE role = 'system'
UNION ALL SELECT conv_id, turn, role, text FROM o WHERE n <= 4 OR rn <= greatest(4 - s, 0)
""")
def stream_memory(spark, d):
    schema = Tables(spark, d).conversations.schema
    s = spark.readStream.schema(schema).parquet(f"{d}/conversations.parque[t]")
    m = ST.stream_memory(s.select("conv_id", "turn", "role", "text"), 4)
    return ST.run_available(m, "memory", mode="update", group=["conv_id"])


@query("stream_run_logs", """
SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS block_id,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS started,
  CAST(sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS BIGINT) AS completed,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS skipped,
  CAST(0 AS BIGINT) AS timeout, CAST(sum(CAST(trunc(value * 1000) AS BIGINT)) AS BIGINT) AS total_ms
FROM events GROUP BY user_id, event_type
""")
def stream_run_logs(spark, d):
    s = _events_stream(spark, d)
    ev = (F.when(F.col("event_type") == "view", "started").when(F.col("event_type").isin("click", "purchase"), "completed")
          .when(F.col("event_type") == "error", "failed").otherwise("skipped"))
    logs = s.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("block_id"),
                    ev.alias("event"), (F.col("value") * 1000).cast("long").alias("duration_ms"))
    return ST.run_available(ST.stream_run_rollup(logs), "runlogs", keys=["run_id", "block_id"], mode="update")


@query("stream_ingest", f"""
WITH {_REINGEST_SQL}
SELECT CAST(doc_id AS VARCHAR) || ':' || CAST(CAST(s / 462 AS INTEGER) AS VARCHAR) AS id, CAST(doc_id AS VARCHAR) AS document_id,
  CAST(s / 462 AS INTEGER) AS chunk_no, md5(substr(text, s + 1, 512)) AS text_md5, 'default' AS collection FROM c
""")
def stream_ingest(spark, d):
    docs = Tables(spark, d).documents
    s = spark.readStream.schema(docs.schema).parquet(f"{d}/documents.parque[t]")
    target, landing = ST.scratch_path(spark, "chunks"), ST.scratch_path(spark, "landing")
    ST.start_ingest(s.select("doc_id", "text"), target, ST.scratch_path(spark, "ingest-ckpt"), dims=64)
    _shorter(docs).select("doc_id", "text").write.json(landing)  # later versions land; another stream takes them into the same table
    later = ST.landing_stream(spark, landing, "doc_id long, text string")
    t = ST.start_ingest(later, target, ST.scratch_path(spark, "ingest-ckpt"), dims=64)
    return t.read().select("id", "document_id", "chunk_no", F.md5("text").alias("text_md5"), "collection")


@query("scheduled_batch", "SELECT event_id, event_type, value FROM events WHERE value > 45")
def scheduled_batch(spark, d):
    s = _events_stream(spark, d).select("event_id", "event_type", "value")
    return ST.run_available(s.filter(F.col("value") > 45), "scheduled")


# -------------------------------------------------------------- user code


@query("register_operator", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def register_operator(spark, d):
    U.register_operator("big_orders", lambda df, cfg: df.filter(F.col("o_totalprice") > cfg.get("min", 0)))
    try:
        return U.apply_operator(Tables(spark, d).orders, "big_orders", {"min": 250000}).select("o_orderkey", "o_totalprice")
    finally:
        U.unregister_operator("big_orders")


@query("code_rows", "SELECT o_orderkey, round_even(o_totalprice / 1000, 1) AS price_k FROM orders")
def code_rows(spark, d):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"o_orderkey": pdf["o_orderkey"], "price_k": (pdf["o_totalprice"] / 1000).round(1)})
    return U.code_rows(Tables(spark, d).orders.select("o_orderkey", "o_totalprice"), fn, "o_orderkey long, price_k double")


@query("code_groups", """
SELECT o_custkey, max(o_totalprice) - min(o_totalprice) AS spread FROM orders GROUP BY o_custkey
""")
def code_groups(spark, d):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        price = pdf["o_totalprice"].to_numpy()  # fmax and fmin leave nulls out
        return pd.DataFrame({"o_custkey": pdf["o_custkey"].to_numpy()[:1], "spread": np.fmax.reduce(price, keepdims=True) - np.fmin.reduce(price, keepdims=True)})
    return U.code_groups(Tables(spark, d).orders.select("o_custkey", "o_totalprice"), ["o_custkey"], fn,
                         "o_custkey long, spread double")


@query("transform_context", """
SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations WHERE role <> 'system') WHERE rn <= 2
""")
def transform_context(spark, d):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        keep = pdf[pdf["role"] != "system"].tail(2)
        return keep[["conv_id", "turn", "role"]]
    return U.transform_context(Tables(spark, d).conversations.select("conv_id", "turn", "role"), fn,
                               "conv_id long, turn long, role string")


@query("webhook_source", "SELECT doc_id, lang FROM documents")
def webhook_source(spark, d):
    schema = Tables(spark, d).documents.schema
    s = ST.landing_stream(spark, f"{d}/documents.parque[t]", schema, fmt="parquet")
    return ST.run_available(s.select("doc_id", "lang"), "landing")


@query("feed_poll", """
SELECT CAST(user_id AS VARCHAR) AS feed, CASE WHEN user_id % 2 = 0 THEN 'rss' ELSE 'atom' END AS format, 'urn:event:' || event_id AS entry_id,
  event_type || ' & more' AS title, 'https://example.org/e/' || event_id AS link, date_trunc('second', ts) AS published,
  CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS run FROM events
""")
def feed_poll(spark, d):
    # a feed for each user; the first snapshots lack every third entry, the second ones have all
    ev = Tables(spark, d).events
    at = F.date_trunc("second", "ts")
    key, link, title = F.concat(F.lit("urn:event:"), "event_id"), F.concat(F.lit("https://example.org/e/"), "event_id"), F.concat("event_type", F.lit(" &amp; more"))
    rss = F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), link, F.lit('</link><guid isPermaLink="false">'), key,
                   F.lit("</guid><pubDate>"), F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>"))
    atom = F.concat(F.lit("<entry><id>"), key, F.lit('</id><title>'), title, F.lit('</title><link rel="self" href="x"/><link href="'), link,
                    F.lit('"/><published>'), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</published></entry>"))
    is_rss = F.col("user_id") % 2 == 0
    ev = ev.select("user_id", "event_id", F.when(is_rss, rss).otherwise(atom).alias("entry"))
    folder, target, checkpoint = (ST.scratch_path(spark, n) for n in ("feeds", "entries", "feeds-ckpt"))
    runs = []
    for run, rows in ((1, ev.filter(F.col("event_id") % 3 != 0)), (2, ev)):
        body = rows.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "entry")), asc=False), lambda x: x["entry"]), "").alias("body"))
        xml = F.when(is_rss, F.concat(F.lit('<rss version="2.0"><channel><title>t</title>'), "body", F.lit("</channel></rss>"))).otherwise(
            F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'), "body", F.lit("</feed>")))
        FD.land(body.select(F.col("user_id").cast("string").alias("feed"), F.lit(run).alias("poll"), xml.alias("document")), folder)
        runs.append(FD.new_entries(spark, folder, target, checkpoint).withColumn("run", F.lit(run)))
    new = runs[0].unionByName(runs[1])
    return new.select("feed", "format", "entry_id", "title", "link", F.col("published").cast("timestamp_ntz").alias("published"), "run")


@query("ingest_bridge", f"SELECT CAST(vec_id AS VARCHAR) AS id, label, {_VECTOR_SQL.format('embedding')} AS vector, 'vectors' AS collection FROM embeddings")
def ingest_bridge(spark, d):
    emb = Tables(spark, d).embeddings
    s = spark.readStream.schema(emb.schema).parquet(f"{d}/embeddings.parque[t]")
    t = ST.bridge_to_collection(s.select(F.col("vec_id").cast("string").alias("id"), "label", "embedding"), ST.scratch_path(spark, "bridge"),
                                ST.scratch_path(spark, "bridge-ckpt"), key="id", collection="vectors")
    return t.read().select("id", "label", _vector_text("embedding").alias("vector"), "collection")


def _register_export():
    from tessera.queries import SQL as _SQL
    from tessera.queries.shapes import format_answer as _fa  # noqa: F401  (registers its twin first)

    answers = _SQL["format_answer"]
    query("export_answers", f"""
WITH a AS ({answers})
SELECT 'json' AS form, s_suppkey, answer FROM a UNION ALL SELECT 'markdown', s_suppkey, answer FROM a UNION ALL SELECT 'text', NULL, answer FROM a
""")(export_answers)


_register_export()
