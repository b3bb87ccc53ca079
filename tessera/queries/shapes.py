"""Routing, column shaping and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as C
from tessera.operators import ordering as O
from tessera.operators import routing as R
from tessera.operators import shaping as P
from tessera.queries import query
from tessera.session import Tables

# ---------------------------------------------------------------- routing


@query("condition_split", """
SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 'true' ELSE 'false' END AS branch FROM orders
""")
def condition_split(spark, d):
    o = Tables(spark, d).orders
    return R.split_condition(o, "o_totalprice", "gt", 150000).select("o_orderkey", "branch")


@query("switch_static", "SELECT o_orderkey, 'archive' AS output FROM orders")
def switch_static(spark, d):
    return R.switch_static(Tables(spark, d).orders, "archive").select("o_orderkey", "output")


SWITCH_RULES = [
    {"output": "high", "conditions": [("l_quantity", "gt", 40)]},
    {"output": "returned", "conditions": [("l_returnflag", "equals", "R")]},
    {"output": "default", "conditions": [("l_linestatus", "equals", "F")]},
]


@query("switch_rules", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN 'high' WHEN l_returnflag = 'R' THEN 'returned'
  ELSE 'default' END AS output FROM lineitem
""")
def switch_rules(spark, d):
    li = Tables(spark, d).lineitem
    return R.switch_rules(li, SWITCH_RULES).select("l_orderkey", "l_linenumber", "output")


KEYWORD_ROUTES = [
    {"name": "english", "condition": "the, and, of, is"},
    {"name": "french", "condition": ["le", "la", "les", "des"]},
    {"name": "german", "condition": "der, die, und, das"},
    {"name": "spanish", "condition": "el, los, las, por"},
]


def _kw_sql(name, kws):
    parts = " + ".join(f"CAST(contains(lower(text), '{k}') AS INTEGER)" for k in kws)
    return f"({parts}) / {float(len(kws))} AS s_{name}"


_KW = ", ".join(_kw_sql(r["name"], [k.strip() for k in (r["condition"].split(",") if isinstance(r["condition"], str) else r["condition"])])
                for r in KEYWORD_ROUTES)


@query("route_keyword", f"""
SELECT doc_id,
  CASE WHEN g <= 0 THEN 'default' WHEN s_english = g THEN 'english' WHEN s_french = g THEN 'french'
       WHEN s_german = g THEN 'german' ELSE 'spanish' END AS route,
  CASE WHEN g <= 0 THEN 0.0 ELSE g END AS confidence
FROM (SELECT *, greatest(s_english, s_french, s_german, s_spanish) AS g FROM
  (SELECT doc_id, {_KW} FROM documents))
""")
def route_keyword(spark, d):
    docs = Tables(spark, d).documents
    return R.route_keyword(docs, "text", KEYWORD_ROUTES).select("doc_id", "route", "confidence")


REGEX_ROUTES = [
    {"name": "email", "condition": r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}"},
    {"name": "phone", "condition": r"\d{3}[-. ]\d{3}[-. ]\d{4}"},
    {"name": "url", "condition": r"https?://"},
]


@query("route_regex", r"""
SELECT doc_id,
  CASE WHEN regexp_matches(lower(text), '[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}') THEN 'email'
       WHEN regexp_matches(lower(text), '\d{3}[-. ]\d{3}[-. ]\d{4}') THEN 'phone'
       WHEN regexp_matches(lower(text), 'https?://') THEN 'url' ELSE 'other' END AS route,
  CASE WHEN regexp_matches(lower(text), '[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}|\d{3}[-. ]\d{3}[-. ]\d{4}|https?://')
       THEN 1.0 ELSE 0.0 END AS confidence
FROM documents
""")
def route_regex(spark, d):
    docs = Tables(spark, d).documents
    return R.route_regex(docs, "text", REGEX_ROUTES, default="other").select("doc_id", "route", "confidence")


@query("policy_gate", """
SELECT event_id, reason IS NULL AS allowed, reason FROM (SELECT event_id,
  CASE WHEN event_type IN ('error') THEN 'tool ' || event_type || ' is blocked'
       WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'tool ' || event_type || ' is not allowed'
  END AS reason FROM events)
""")
def policy_gate(spark, d):
    # each event is a tool call; the event type is the tool name
    calls = Tables(spark, d).events.select("event_id", F.col("event_type").alias("tool"))
    g = R.policy_gate(calls, "tool", blocked=["error"], allowed=["click", "view", "purchase"])
    return g.select("event_id", "allowed", "reason")


SKILLS = [
    {"name": "customer-support", "description": "help customers with orders, refunds and account questions",
     "allowed_tools": ["lookup_order", "refund"]},
    {"name": "data-analysis", "description": "analyze tables, compute statistics and summarize results",
     "allowed_tools": ["sql", "chart"]},
    {"name": "legal-review", "description": "review contracts, licenses and clauses for risk",
     "allowed_tools": []},
    {"name": "research", "description": "search the web and documents to answer questions with citations",
     "allowed_tools": ["search", "sql"]},
]

_TOK = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"


def _skill_scores(col):
    toks = _TOK.format(c=col)
    out = []
    for s in sorted(SKILLS, key=lambda r: r["name"]):
        hay = f"{s['name']} {s['description']}".lower()
        out.append(f"len(list_filter({toks}, lambda t: contains('{hay}', t))) AS \"{s['name']}\"")
    return ", ".join(out)


def _skill_pick():
    names = [s["name"] for s in sorted(SKILLS, key=lambda r: r["name"])]
    g = "greatest(" + ", ".join(f'"{n}"' for n in names) + ")"
    case = " ".join(f"WHEN \"{n}\" = g THEN '{n}'" for n in names)
    return g, case


_G, _CASE = _skill_pick()


@query("skill_match", f"""
SELECT item_id, CASE WHEN g > 0 THEN (CASE {_CASE} END) END AS skill, CAST(g AS BIGINT) AS score
FROM (SELECT *, {_G} AS g FROM (SELECT item_id, {_skill_scores('text')} FROM benchmark))
""")
def skill_match(spark, d):
    b = Tables(spark, d).benchmark
    return R.skill_match(b, "text", SKILLS).select("item_id", "skill", "score")


_TOOLS_VALUES = ", ".join(f"('{s['name']}', '{t}')" for s in SKILLS for t in s["allowed_tools"])


@query("allowed_tools_union", f"""
WITH chosen AS (
  SELECT source, CASE WHEN g > 0 THEN (CASE {_CASE} END) END AS skill
  FROM (SELECT *, {_G} AS g FROM (SELECT source, {_skill_scores('text')} FROM documents))),
tools(skill, tool) AS (VALUES {_TOOLS_VALUES})
SELECT c.source, string_agg(DISTINCT t.tool, ',' ORDER BY t.tool) AS allowed_tools
FROM (SELECT DISTINCT source, skill FROM chosen) c LEFT JOIN tools t ON c.skill = t.skill
GROUP BY c.source
""")
def allowed_tools_union(spark, d):
    docs = Tables(spark, d).documents
    chosen = R.skill_match(docs, "text", SKILLS).select("source", "skill")
    u = R.allowed_tools(chosen, SKILLS, by="source")
    return u.select("source", F.array_join("allowed_tools", ",").alias("allowed_tools"))


# ---------------------------------------------------------------- shaping


@query("set_fields", """
SELECT o_orderkey, 'active' AS status, 42.0 AS count, true AS flag, 1 AS obj_a FROM orders
""")
def set_fields(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    s = P.set_fields(o, [("status", "string", "active"), ("count", "number", "42"),
                         ("flag", "boolean", "true"), ("obj", "object", '{"a": 1}')])
    return s.select("o_orderkey", "status", "count", "flag", F.col("obj.a").alias("obj_a"))


@query("set_json", "SELECT c_custkey, 'gold' AS tier, 5 AS lim FROM customer")
def set_json(spark, d):
    c = Tables(spark, d).customer.select("c_custkey")
    bad = P.set_json(c, "{not json")
    return P.set_json(bad, '{"tier": "gold", "lim": 5}')


def _nested(spark, d):
    # stand-in nested items: one struct and one list of structs per line
    li = Tables(spark, d).lineitem
    return li.select(
        "l_orderkey", "l_linenumber",
        F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).alias("info"),
        F.array(F.struct(F.col("l_quantity").alias("q"), F.col("l_discount").alias("d")),
                F.struct(F.col("l_tax").alias("q"), F.col("l_extendedprice").alias("d"))).alias("parts"))


_NESTED_SQL = """(SELECT l_orderkey, l_linenumber,
  {'flag': l_returnflag, 'status': l_linestatus} AS info,
  [{'q': l_quantity, 'd': l_discount}, {'q': l_tax, 'd': l_extendedprice}] AS parts FROM lineitem)"""


@query("select_paths", f"""
SELECT l_orderkey, info.flag AS info_flag, parts[2].q AS parts_1_q_idx, NULL::DOUBLE AS bad,
  array_to_string(list_transform(parts, lambda x: CAST(x.q AS VARCHAR)), ',') AS parts_q
FROM {_NESTED_SQL}
""")
def select_paths(spark, d):
    n = _nested(spark, d)
    s = P.select_paths(n, ["l_orderkey", "info.flag", "parts[1].q", "parts[7].q", "parts[].q"],
                       rename={"parts[1].q": "parts_1_q_idx", "parts[7].q": "bad"})
    return s.withColumn("parts_q", F.array_join(F.transform("parts_q", lambda x: x.cast("string")), ","))


@query("rename_paths", f"""
SELECT l_orderkey AS id, info.status AS info_status, parts[1].d AS "parts[0]_d" FROM {_NESTED_SQL}
""")
def rename_paths(spark, d):
    n = _nested(spark, d)
    return P.select_paths(n, ["l_orderkey", "info.status", "parts[0].d"], rename={"l_orderkey": "id"})


@query("flatten_struct", f"""
SELECT l_orderkey, l_linenumber, info.flag AS info_flag, info.status AS info_status FROM {_NESTED_SQL}
""")
def flatten_struct(spark, d):
    n = _nested(spark, d).drop("parts")
    return P.flatten_struct(n)


@query("column_arrays", f"""
SELECT array_to_string(list_transform(parts, lambda x: CAST(x.d AS VARCHAR)), ',') AS parts FROM {_NESTED_SQL}
""")
def column_arrays(spark, d):
    c = P.columns_of(_nested(spark, d))
    return c.select(F.array_join(F.transform("parts", lambda x: x["d"].cast("string")), ",").alias("parts"))


@query("parse_json_column", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def parse_json_column(spark, d):
    e = Tables(spark, d).events.select("event_id", "props")
    p = P.parse_json(e, "props", "k long")
    return p.select("event_id", F.col("props.k").alias("k"))


def _fmt_num_sql(x):
    return (f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END")


@query("format_answer", f"""
WITH top AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, l_returnflag,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank
  FROM lineitem)
SELECT s.s_suppkey,
  CASE WHEN length(s.s_name) > 12 THEN substr(s.s_name, 1, 12) || '...' ELSE s.s_name END
  || CASE WHEN count(t.rank) > 0 THEN E'\\n\\n---\\n**Sources:**\\n' || string_agg('- ' || t.l_returnflag || ' (score: '
     || {_fmt_num_sql('t.l_extendedprice')} || ')', E'\\n' ORDER BY t.rank) ELSE '' END AS answer
FROM supplier s LEFT JOIN (SELECT * FROM top WHERE rank <= 3) t ON s.s_suppkey = t.l_suppkey
GROUP BY s.s_suppkey, s.s_name
""")
def format_answer(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.withColumn("_tb", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    top = O.top_k(li, ["l_suppkey"], "l_extendedprice", 3, tiebreak="_tb")
    # at most 3 results per supplier: the collected list is bounded by k
    res = top.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("rank"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_returnflag").alias("src")))).alias("_r"))
    res = res.select("l_suppkey", F.transform("_r", lambda r: F.struct(
        r["id"].alias("id"), r["score"].alias("score"),
        F.create_map(F.lit("source"), r["src"]).alias("metadata"))).alias("results"))
    sup = t.supplier
    s = sup.join(res, sup.s_suppkey == res.l_suppkey, "left").select(
        "s_suppkey", F.col("s_name").alias("text"), "results")
    a = P.format_answer(s, "markdown", True, 12)
    return a.select("s_suppkey", "answer")


@query("render_template", """
SELECT conv_id, turn, '[' || role || '] #' || CAST(turn AS VARCHAR) || ': ' || text || ' / ' AS prompt,
  'You are helpful.' AS system_prompt FROM conversations
""")
def render_template(spark, d):
    c = Tables(spark, d).conversations
    r = P.render_template(c, "[{{ role }}] #{{turn}}: {{text}} / {{missing}}", "You are {{persona}}.",
                          variables={"persona": "helpful"})
    return r.select("conv_id", "turn", "prompt", "system_prompt")


@query("with_variables", "SELECT c_custkey, 'gold' AS tier, NULL AS missing FROM customer")
def with_variables(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name")
    return P.with_variables(c, {"tier": "gold"}, keys=["c_custkey", "tier", "missing"])


@query("default_columns", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END, 'base')
  AS model, 'main' AS collection FROM orders
""")
def default_columns(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.when(
        F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("model"))
    return P.default_columns(o, {"model": "base", "collection": "main"})


@query("project_fields", f"SELECT l_orderkey, info.status AS \"info.status\" FROM {_NESTED_SQL}")
def project_fields(spark, d):
    n = _nested(spark, d)
    return P.project_fields(n, include=["l_orderkey", "info.status"], exclude=["l_orderkey"])


@query("format_citation", """
SELECT doc_id, '[' || source || ':' || CAST(n_chars AS VARCHAR) || '] ' || lang AS citation FROM documents
""")
def format_citation(spark, d):
    docs = Tables(spark, d).documents.select(
        "doc_id", "lang", "n_chars", F.create_map(F.lit("title"), F.col("source")).alias("metadata"))
    c = P.format_citation(docs, "[{title}:{n_chars}] {lang}")
    return c.select("doc_id", "citation")


@query("rename_case", """
SELECT c_custkey AS cCustkey, c_name AS cName, c_nationkey AS cNationkey, c_acctbal AS cAcctbal,
  c_mktsegment AS cMktsegment FROM customer
""")
def rename_case(spark, d):
    c = Tables(spark, d).customer
    back = P.rename_case(P.rename_case(c, "camel"), "snake")
    return P.rename_case(back, "camel")


_EV_SCHEMA = {"type": "object", "properties": {"k": {"type": "integer"}, "name": {"type": "string"}},
              "required": ["k", "name"]}


@query("cast_schema", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  array_to_string(list_filter([CASE WHEN json_extract(props, '$.k') IS NULL THEN 'k' END,
    CASE WHEN json_extract(props, '$.name') IS NULL THEN 'name' END], lambda x: x IS NOT NULL), ',') AS violations
FROM events
""")
def cast_schema(spark, d):
    e = Tables(spark, d).events.select("event_id", "props")
    p = P.apply_json_schema(e, "props", _EV_SCHEMA)
    return p.select("event_id", F.col("value.k").alias("k"), F.array_join("violations", ",").alias("violations"))


# ---------------------------------------------------------------- scalars


@query("dt_format", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, 'Day %d of %m, %Y at %H:%M:%S') AS formatted FROM lineitem
""")
def dt_format(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     C.dt_format(F.col("l_shipdate"), "Day dd of MM, yyyy at HH:mm:ss").alias("formatted"))


@query("dt_now", "SELECT o_orderkey, strftime(now() AT TIME ZONE 'UTC', '%Y-%m-%d') AS today FROM orders")
def dt_now(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", C.dt_now("yyyy-MM-dd").alias("today"))


@query("dt_add", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate + INTERVAL 36 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted FROM lineitem
""")
def dt_add(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     C.dt_format(C.dt_shift(F.col("l_shipdate"), 36, "hours")).alias("shifted"))


@query("dt_subtract", """
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 90 MINUTE - INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS shifted FROM orders
""")
def dt_subtract(spark, d):
    o = Tables(spark, d).orders
    s = C.dt_shift(C.dt_shift(F.col("o_orderdate"), 90, "minutes", -1), 2, "fortnights", -1)
    return o.select("o_orderkey", C.dt_format(s).alias("shifted"))


@query("dt_diff", """
SELECT l.l_orderkey, l.l_linenumber, epoch(l.l_shipdate) - epoch(o.o_orderdate) AS diff_s
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def dt_diff(spark, d):
    t = Tables(spark, d)
    li, o = t.lineitem, t.orders
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", C.dt_diff(F.col("o_orderdate"), F.col("l_shipdate")).alias("diff_s"))


@query("dt_parse", """
SELECT event_id, CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS from_text,
  make_timestamp(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000) AS from_ms FROM events
""")
def dt_parse(spark, d):
    e = Tables(spark, d).events
    src = e.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
                   F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("ms"))
    return src.select("event_id", C.dt_parse(F.col("iso")).cast("timestamp_ntz").alias("from_text"),
                      C.dt_parse(F.col("ms"), is_millis=True).cast("timestamp_ntz").alias("from_ms"))


@query("cast_bool", """
SELECT o_orderkey, v = 'true' AS set_style, lower(trim(v)) IN ('true', '1', 'yes') AS extract_style FROM
(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN ' Yes' ELSE '0' END AS v FROM orders)
""")
def cast_bool(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "true")
                                       .when(F.col("o_orderstatus") == "O", " Yes").otherwise("0").alias("v"))
    return o.select("o_orderkey", C.cast_bool(F.col("v")).alias("set_style"),
                    C.cast_bool(F.col("v"), "extract").alias("extract_style"))


@query("cast_number", """
SELECT l_orderkey, l_linenumber, l_quantity AS num, CAST(l_quantity AS BIGINT) AS lead_int,
  l_tax AS lead_float FROM lineitem
""")
def cast_number(spark, d):
    from tessera.functions.jsvalues import js_number
    from pyspark.sql import types as T
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("  "), F.col("l_quantity").cast("string"), F.lit(" ")).alias("t1"),
        F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("pcs")).alias("t2"),
        F.concat(F.col("l_tax").cast("string"), F.lit("% tax")).alias("t3"))
    return li.select("l_orderkey", "l_linenumber", js_number(F.col("t1"), T.StringType()).alias("num"),
                     C.lead_number(F.col("t2"), "int").alias("lead_int"),
                     C.lead_number(F.col("t3"), "float").alias("lead_float"))


@query("json_path", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.missing') IS NULL AS no_missing
FROM events
""")
def json_path(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", C.json_path(F.col("props"), "k", "long").alias("k"),
                    C.json_path(F.col("props"), "missing.x", "string").isNull().alias("no_missing"))


@query("slugify", r"""
SELECT p_partkey, CASE WHEN n = 0 THEN base ELSE base || '_' || CAST(n AS VARCHAR) END AS slug FROM (
  SELECT p_partkey, base, row_number() OVER (PARTITION BY base ORDER BY p_partkey) - 1 AS n FROM (
    SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(p_name || '!' || p_brand),
      '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'node') AS base FROM part))
""")
def slugify(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.concat("p_name", F.lit("!"), "p_brand").alias("name"))
    return C.slugify(p, "name", ["p_partkey"]).select("p_partkey", "slug")


@query("title_case", """
SELECT p_partkey, array_to_string(list_transform(string_split(replace(s, '_', ' '), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM (SELECT p_partkey, replace(p_name, ' ', '_') AS s FROM part)
""")
def title_case(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.regexp_replace("p_name", " ", "_").alias("s"))
    return p.select("p_partkey", C.title_case(F.col("s")).alias("title"))


@query("valid_name", r"""
SELECT p_partkey, regexp_matches(n, '^[a-zA-Z_][a-zA-Z0-9_]*$') AS valid FROM
(SELECT p_partkey, CASE WHEN p_size > 25 THEN replace(p_name, ' ', '_') ELSE p_name END AS n FROM part)
""")
def valid_name(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.when(
        F.col("p_size") > 25, F.regexp_replace("p_name", " ", "_")).otherwise(F.col("p_name")).alias("n"))
    return p.select("p_partkey", C.valid_name(F.col("n")).alias("valid"))


@query("token_estimate", "SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", C.token_estimate(F.col("text")).alias("tokens"))


@query("json_array_parse", """
SELECT event_id, json_valid(a) AS ok,
  CASE WHEN NOT json_valid(a) THEN 'Invalid JSON in tool arguments. Raw: ' || substr(a, 1, 200) END AS error
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 1, 5) ELSE props END AS a FROM events)
""")
def json_array_parse(spark, d):
    e = Tables(spark, d).events.select("event_id", F.when(
        F.col("event_type") == "error", F.substring("props", 1, 5)).otherwise(F.col("props")).alias("a"))
    v, err = C.parse_args(F.col("a"))
    return e.select("event_id", v.isNotNull().alias("ok"), err.alias("error"))


@query("keyword_tokens", """
SELECT item_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM
(SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM benchmark)
""")
def keyword_tokens(spark, d):
    b = Tables(spark, d).benchmark.select("item_id", C.keyword_tokens(F.col("text")).alias("t"))
    return b.select("item_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("query_lines", """
SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split(text, E'\\n'), lambda x: trim(x)),
  lambda x: x <> '')[1:3], '|') AS queries FROM conversations
""")
def query_lines(spark, d):
    c = Tables(spark, d).conversations
    return c.select("conv_id", "turn", F.array_join(C.query_lines(F.col("text"), 3), "|").alias("queries"))
