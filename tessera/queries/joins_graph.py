"""Merge, edge, evidence-join and graph-audit queries.

Stand-in graph (built from ``conversations``): a node per turn
(``graph = conv_id``, ``id = conv_id:turn``, ``type = role``); a ``follows``
edge from every turn to the next turn number (the last one dangles); a
``retry`` edge from the last turn back to turn 0 when the last turn is a user
message (these make the cycles).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators import joins as J
from tessera.operators.ordering import positions
from tessera.queries import query
from tessera.session import Tables


def _nodes(spark, d):
    c = Tables(spark, d).conversations
    return c.select(F.col("conv_id").alias("graph"),
                    F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("role").alias("type"))


def _edges(spark, d):
    c = Tables(spark, d).conversations
    follows = c.select(F.col("conv_id").alias("graph"),
                       F.concat_ws(":", "conv_id", "turn").alias("source"),
                       F.concat_ws(":", "conv_id", (F.col("turn") + 1).cast("string")).alias("target"),
                       F.lit("follows").alias("relation"), F.lit(1.0).alias("weight"))
    last = c.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"), F.max("turn").alias("mt"))
    retry = last.filter(F.col("last_role") == "user").select(
        F.col("conv_id").alias("graph"), F.concat_ws(":", "conv_id", "mt").alias("source"),
        F.concat(F.col("conv_id").cast("string"), F.lit(":0")).alias("target"),
        F.lit("retry").alias("relation"), F.lit(0.5).alias("weight"))
    return follows.unionByName(retry)


NODES_SQL = "(SELECT conv_id AS graph, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS id, role AS type FROM conversations)"
EDGES_SQL = """(
  SELECT conv_id AS graph, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS source,
    CAST(conv_id AS VARCHAR) || ':' || CAST(turn + 1 AS VARCHAR) AS target, 'follows' AS relation, 1.0 AS weight
  FROM conversations
  UNION ALL
  SELECT conv_id, CAST(conv_id AS VARCHAR) || ':' || CAST(mt AS VARCHAR), CAST(conv_id AS VARCHAR) || ':0', 'retry', 0.5
  FROM (SELECT conv_id, arg_max(role, turn) AS last_role, max(turn) AS mt FROM conversations GROUP BY conv_id)
  WHERE last_role = 'user')"""


# ------------------------------------------------------------------ merges


@query("merge_append", """
SELECT id, name, bal, nation, source_no FROM (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal, NULL::INTEGER AS nation, 0 AS source_no FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, NULL, s_nationkey, 1 FROM supplier)
""")
def merge_append(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return J.merge_append(a, b).select("id", "name", "bal", "nation", "source_no")


@query("merge_combine", """
SELECT coalesce(a.pos, b.pos) AS pos, CASE WHEN b.pos IS NOT NULL THEN b.id ELSE a.id END AS id,
  CASE WHEN b.pos IS NOT NULL THEN b.name ELSE a.name END AS name, a.bal, b.nation
FROM (SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS pos, c_custkey AS id, c_name AS name, c_acctbal AS bal FROM customer) a
FULL OUTER JOIN (SELECT row_number() OVER (ORDER BY s_name, s_suppkey) - 1 AS pos, s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier) b
ON a.pos = b.pos
""")
def merge_combine(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    # the orders must be total: acctbal then the unique key
    return J.merge_by_position(a, b, ["bal", "id"], ["name", "id"])


@query("merge_choose_branch", """
SELECT o_orderkey, o_orderstatus, 1 AS source_no FROM orders WHERE o_orderstatus = 'P'
""")
def merge_choose_branch(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    empty = o.filter(F.col("o_totalprice") < 0)
    pending = o.filter(F.col("o_orderstatus") == "P")
    late = o.filter(F.col("o_orderstatus") == "F")
    return J.merge_first(empty, pending, late).select("o_orderkey", "o_orderstatus", "source_no")


@query("overlay", """
SELECT a.c_custkey, coalesce(b.c_name, a.c_name) AS c_name, coalesce(b.c_acctbal, a.c_acctbal) AS c_acctbal, b.flag
FROM customer a FULL OUTER JOIN (SELECT c_custkey, NULL::VARCHAR AS c_name, round(c_acctbal + 100, 2) AS c_acctbal,
  true AS flag FROM customer WHERE c_mktsegment = 'BUILDING') b ON a.c_custkey = b.c_custkey
""")
def overlay(spark, d):
    t = Tables(spark, d)
    a = t.customer.select("c_custkey", "c_name", "c_acctbal")
    b = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.lit(None).cast("string").alias("c_name"),
        F.round(F.col("c_acctbal") + 100, 2).alias("c_acctbal"), F.lit(True).alias("flag"))
    return J.overlay(a, b, "c_custkey")


# ------------------------------------------------------------------- edges


@query("add_edges", f"""
WITH e AS {EDGES_SQL},
old AS (SELECT source, target, relation, weight FROM e WHERE relation = 'follows'),
new AS (SELECT source, target, relation, weight FROM e WHERE relation = 'retry'
        UNION ALL SELECT source, target, 'related_to', 2.0 FROM e WHERE relation = 'follows' AND starts_with(target, '1'))
SELECT source, target, relation, min_by(weight, src) AS weight, min(src) = 1 AS added FROM (
  SELECT *, 0 AS src FROM old UNION ALL SELECT *, 1 FROM new) GROUP BY source, target, relation
""")
def add_edges(spark, d):
    e = _edges(spark, d)
    old = e.filter(F.col("relation") == "follows").select("source", "target", "relation", "weight")
    new = e.filter(F.col("relation") == "retry").select("source", "target", "relation", "weight").unionByName(
        e.filter((F.col("relation") == "follows") & F.col("target").startswith("1"))
        .select("source", "target", F.lit(None).cast("string").alias("relation"), F.lit(2.0).alias("weight")))
    return J.add_edges(old, new)


@query("list_edges", f"""
WITH e AS {EDGES_SQL}, n AS {NODES_SQL}
SELECT source, target, relation, 'outgoing' AS direction FROM e WHERE source IN (SELECT id FROM n WHERE type = 'system')
UNION ALL
SELECT source, target, relation, 'incoming' FROM e WHERE target IN (SELECT id FROM n WHERE type = 'system')
""")
def list_edges(spark, d):
    sys_nodes = _nodes(spark, d).filter(F.col("type") == "system").select("id")
    both = J.list_edges(_edges(spark, d), sys_nodes, "both")
    return both.select("source", "target", "relation", "direction")


@query("delete_edge", f"""
WITH e AS {EDGES_SQL}, n AS {NODES_SQL}
SELECT e.source, e.target, e.relation FROM e WHERE NOT EXISTS (
  SELECT 1 FROM e k JOIN n ON k.source = n.id AND n.type = 'system'
  WHERE k.source = e.source AND k.target = e.target AND k.relation = e.relation)
""")
def delete_edge(spark, d):
    e = _edges(spark, d)
    sys_nodes = _nodes(spark, d).filter(F.col("type") == "system").select(F.col("id").alias("source"))
    keys = e.join(sys_nodes, "source", "left_semi")
    return J.delete_edges(e, keys).select("source", "target", "relation")


@query("expand_neighbors", f"""
WITH e AS {EDGES_SQL}, n AS {NODES_SQL},
hits AS (SELECT graph AS query_id, id FROM n WHERE type = 'user'),
nb AS (SELECT source AS node, target AS nid, relation, weight, 'outgoing' AS direction FROM e
       UNION ALL SELECT target, source, relation, weight, 'incoming' FROM e),
j AS (SELECT h.query_id, h.id, nb.nid, nb.relation, nb.direction, nb.weight,
        row_number() OVER (PARTITION BY h.query_id, h.id ORDER BY nb.weight DESC, nb.nid, nb.relation, nb.direction) AS rn
      FROM hits h JOIN nb ON h.id = nb.node)
SELECT h.query_id, h.id, coalesce(string_agg(j.nid || '/' || j.relation || '/' || j.direction, ',' ORDER BY j.rn), '') AS neighbors
FROM hits h LEFT JOIN (SELECT * FROM j WHERE rn <= 2) j ON h.query_id = j.query_id AND h.id = j.id
GROUP BY h.query_id, h.id
""")
def expand_neighbors(spark, d):
    hits = _nodes(spark, d).filter(F.col("type") == "user").select(F.col("graph").alias("query_id"), "id")
    x = J.expand_neighbors(hits, _edges(spark, d), direction="both", cap=2)
    return x.select("query_id", "id", F.array_join(F.transform("neighbors", lambda s: F.concat_ws(
        "/", s["id"], s["relation"], s["direction"])), ",").alias("neighbors"))


def _search_graph_sql(hops):
    from tessera.queries.docs_search import _BM25_SQL

    bm25 = _BM25_SQL.replace("FROM documents", "FROM corpus").replace("rank <= 10", "rank <= 3").strip()
    return f"""
WITH RECURSIVE corpus AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS doc_id, text FROM conversations), {bm25},
e AS {EDGES_SQL},
nb AS (SELECT DISTINCT node, nid FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, nid, relation, direction) AS rn FROM (
  SELECT source AS node, target AS nid, relation, weight, 'outgoing' AS direction FROM e
  UNION ALL SELECT target, source, relation, weight, 'incoming' FROM e)) WHERE rn <= 2),
r(query_id, id, hop) AS (SELECT query_id, id, 0 FROM bm UNION SELECT r.query_id, nb.nid, r.hop + 1 FROM r JOIN nb ON nb.node = r.id WHERE r.hop < {hops}),
v AS (SELECT query_id, id, min(hop) AS hop FROM r GROUP BY ALL)
SELECT s.query_id, e.source, e.target, e.relation, s.hop AS source_hop, t.hop AS target_hop
FROM e JOIN v s ON s.id = e.source JOIN v t ON t.id = e.target AND t.query_id = s.query_id
"""


def _search_graph(spark, d, hops):
    # the three turns that answer a query best, what lies within some steps of them, and the edges among all of these
    from tessera.operators.retrieval import bm25_search

    t = Tables(spark, d)
    turns = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("doc_id"), "text")
    hits = bm25_search(t.benchmark.withColumnRenamed("item_id", "query_id"), turns, 3)
    edges = _edges(spark, d)
    nodes = J.expand_hops(hits.select("query_id", "id"), edges, hops, cap=2)
    sub = J.hit_subgraph(nodes, edges)
    hop = lambda side: nodes.select("query_id", F.col("id").alias(side), F.col("hop").alias(f"{side}_hop"))
    return sub.join(hop("source"), ["query_id", "source"]).join(hop("target"), ["query_id", "target"]).select(
        "query_id", "source", "target", "relation", "source_hop", "target_hop")


@query("search_graph", _search_graph_sql(2))
def search_graph(spark, d):
    return _search_graph(spark, d, 2)


@query("search_graph_deep", _search_graph_sql(3))
def search_graph_deep(spark, d):
    return _search_graph(spark, d, 3)


@query("resolve_bucket", """
WITH dim AS (SELECT n_name AS name, md5(n_name) AS id FROM nation),
v AS (SELECT c.c_custkey, CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN md5(c.c_name)
        WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Atlantis' ELSE n.n_name END AS val
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT v.c_custkey, v.val,
  CASE WHEN regexp_matches(v.val, '^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$')
       THEN replace(v.val, '-', '') ELSE dim.id END AS resolved_id,
  (CASE WHEN regexp_matches(v.val, '^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$')
       THEN replace(v.val, '-', '') ELSE dim.id END) IS NULL AS unresolved
FROM v LEFT JOIN dim ON v.val = dim.name
""")
def resolve_bucket(spark, d):
    t = Tables(spark, d)
    nation = t.nation
    dim = nation.select(F.col("n_name").alias("name"), F.md5("n_name").alias("id"))
    cust = t.customer
    c = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    v = c.select("c_custkey", F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.md5("c_name"))
                 .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("Atlantis")).otherwise(F.col("n_name")).alias("val"))
    return J.resolve_keys(v, "val", dim).select("c_custkey", "val", "resolved_id", "unresolved")


def _agent_events(spark, d):
    """Stand-in tool log from ``events``: a click is a tool call, a view is a
    tool result; the n-th click and the n-th view of a user share a call id."""
    e = Tables(spark, d).events.filter(F.col("event_type").isin("click", "view"))
    p = positions(e, ["user_id", "event_type"], ["ts", "event_id"], name="n")
    return p.select(F.col("user_id").cast("string").alias("run_id"), F.col("n").cast("string").alias("call_id"),
                    F.when(F.col("event_type") == "click", "tool_call").otherwise("tool_result").alias("type"),
                    F.lit("search").alias("tool_name"), "ts",
                    F.when(F.col("event_type") == "view", F.col("props")).alias("result"))


_PAIR_SQL = """
WITH ev AS (SELECT CAST(user_id AS VARCHAR) AS run_id,
    CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS VARCHAR) AS call_id,
    event_type, ts, props FROM events WHERE event_type IN ('click', 'view')),
c AS (SELECT run_id, call_id, 'search' AS tool, ts AS call_ts FROM ev WHERE event_type = 'click'),
r AS (SELECT run_id, call_id, ts AS result_ts, props AS result FROM ev WHERE event_type = 'view')
SELECT coalesce(c.run_id, r.run_id) AS run_id, coalesce(c.call_id, r.call_id) AS call_id, c.tool, c.call_ts,
  r.result_ts, round((epoch_us(r.result_ts) - epoch_us(c.call_ts)) / 1e6, 6) AS duration_s
FROM c FULL OUTER JOIN r ON c.run_id = r.run_id AND c.call_id = r.call_id"""


@query("pair_calls", _PAIR_SQL)
def pair_calls(spark, d):
    p = J.pair_calls(_agent_events(spark, d))
    return p.select("run_id", "call_id", "tool", "call_ts", "result_ts", "duration_s")


@query("verify_citations", """
SELECT item_id, EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text)) AS found FROM benchmark b
""")
def verify_citations(spark, d):
    from tessera.operators.text import verify_citations as vc

    t = Tables(spark, d)
    v = vc(t.benchmark.select(F.col("item_id").alias("cite_id"), "text"),
           t.documents.select("doc_id", "text"))
    return v.select(F.col("cite_id").alias("item_id"), "found")


_SITE = r"regexp_extract(url, '^https?://(?:m\.|blog\.)?([^/]+)', 1)"


@query("union_dedupe_url", rf"""
SELECT question, url, page_id FROM (
  SELECT regexp_extract(url, '/(en|fr|de|es)/', 1) AS question, {_SITE} AS url, page_id,
    row_number() OVER (PARTITION BY regexp_extract(url, '/(en|fr|de|es)/', 1), {_SITE} ORDER BY page_id) AS rn
  FROM pages) WHERE rn = 1
""")
def union_dedupe_url(spark, d):
    p = Tables(spark, d).pages.select(
        F.regexp_extract("url", "/(en|fr|de|es)/", 1).alias("question"),
        F.regexp_extract("url", r"^https?://(?:m\.|blog\.)?([^/]+)", 1).alias("url"), "page_id")
    return J.gather_results(p, ["question"], "url", ["page_id"]).select("question", "url", "page_id")


@query("session_context", """
SELECT conv_id, string_agg(role || ': ' || text, E'\\n' ORDER BY turn) AS history, count(*) AS n_turns FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 3
GROUP BY conv_id
""")
def session_context(spark, d):
    return J.session_turns(Tables(spark, d).conversations, 3)


# ------------------------------------------------------------------- graph


@query("graph_duplicate_nodes", """
SELECT graph, id, count(*) AS copies FROM (SELECT conv_id AS graph, role AS id FROM conversations)
GROUP BY graph, id HAVING count(*) > 1
""")
def graph_duplicate_nodes(spark, d):
    # nodes keyed by role within a conversation: repeated roles are duplicates
    c = Tables(spark, d).conversations.select(F.col("conv_id").alias("graph"), F.col("role").alias("id"))
    return G.duplicate_nodes(c)


@query("graph_dangling_edges", f"""
WITH e AS {EDGES_SQL}, n AS {NODES_SQL}
SELECT graph, source, target, relation, 'source' AS side FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.graph = e.graph AND n.id = e.source)
UNION ALL
SELECT graph, source, target, relation, 'target' FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.graph = e.graph AND n.id = e.target)
""")
def graph_dangling_edges(spark, d):
    return G.dangling_edges(_nodes(spark, d), _edges(spark, d)).select("graph", "source", "target", "relation", "side")


@query("graph_disconnected", f"""
WITH e AS (SELECT * FROM {EDGES_SQL} WHERE relation = 'retry'), n AS {NODES_SQL}
SELECT n.graph, n.id, n.type FROM n WHERE n.graph IN (SELECT graph FROM n GROUP BY graph HAVING count(DISTINCT id) > 1)
AND NOT EXISTS (SELECT 1 FROM e WHERE e.graph = n.graph AND (e.source = n.id OR e.target = n.id))
""")
def graph_disconnected(spark, d):
    e = _edges(spark, d).filter(F.col("relation") == "retry")
    return G.disconnected_nodes(_nodes(spark, d), e).select("graph", "id", "type")


@query("graph_restricted_types", f"SELECT graph, id, type FROM {NODES_SQL} WHERE type IN ('system')")
def graph_restricted_types(spark, d):
    return G.restricted_nodes(_nodes(spark, d), ["system"])


@query("graph_type_mismatch", f"""
WITH e AS {EDGES_SQL}, n AS {NODES_SQL}
SELECT e.graph, e.source, e.target, s.type AS source_type, t.type AS target_type FROM e
JOIN n s ON s.graph = e.graph AND s.id = e.source JOIN n t ON t.graph = e.graph AND t.id = e.target
WHERE s.type IS DISTINCT FROM t.type
""")
def graph_type_mismatch(spark, d):
    n = _nodes(spark, d)
    m = G.port_mismatch(_edges(spark, d), n)
    return m.select("graph", "source", "target", "source_type", "target_type")


_REACH = f"""
WITH RECURSIVE n AS {NODES_SQL},
e AS (SELECT * FROM {EDGES_SQL} x WHERE EXISTS (SELECT 1 FROM {NODES_SQL} a WHERE a.graph = x.graph AND a.id = x.target)),
reach(graph, src, dst) AS (
  SELECT graph, source, target FROM e
  UNION SELECT r.graph, r.src, e.target FROM reach r JOIN e ON r.graph = e.graph AND r.dst = e.source),
cyc AS (SELECT DISTINCT graph, src AS id FROM reach WHERE src = dst),
stuck AS (SELECT graph, id FROM cyc UNION SELECT r.graph, r.dst FROM reach r JOIN cyc c ON r.graph = c.graph AND r.src = c.id),
lp(graph, id, depth) AS (
  SELECT graph, id, 0 FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.graph = n.graph AND e.target = n.id)
  UNION SELECT e.graph, e.target, lp.depth + 1 FROM lp JOIN e ON lp.graph = e.graph AND lp.id = e.source
  WHERE NOT EXISTS (SELECT 1 FROM stuck s WHERE s.graph = e.graph AND s.id = e.target))
"""


@query("graph_cycles", _REACH + """,
back AS (SELECT DISTINCT a.graph, a.src AS id, a.dst AS other FROM reach a JOIN reach b ON a.graph = b.graph AND a.src = b.dst AND a.dst = b.src),
knot AS (SELECT graph, id, min(other) AS knot FROM back GROUP BY graph, id)
SELECT stuck.graph, count(*) AS stuck_nodes, count(knot.id) AS cycle_nodes, count(DISTINCT knot.knot) AS knots, true AS finished
FROM stuck LEFT JOIN knot ON knot.graph = stuck.graph AND knot.id = stuck.id GROUP BY stuck.graph
""")
def graph_cycles(spark, d):
    return G.cyclic_graphs(_nodes(spark, d), _edges(spark, d))


@query("graph_cycle_nodes", _REACH + """
SELECT stuck.graph, stuck.id, cyc.id IS NOT NULL AS on_cycle FROM stuck LEFT JOIN cyc ON cyc.graph = stuck.graph AND cyc.id = stuck.id
""")
def graph_cycle_nodes(spark, d):
    return G.cycle_nodes(_nodes(spark, d), _edges(spark, d)).select("graph", "id", "on_cycle")


@query("graph_layers", _REACH + """
SELECT n.graph, n.id, CAST(max(lp.depth) AS INTEGER) AS layer FROM n LEFT JOIN lp ON n.graph = lp.graph AND n.id = lp.id
GROUP BY n.graph, n.id
""")
def graph_layers(spark, d):
    return G.topo_layers(_nodes(spark, d), _edges(spark, d)).select("graph", "id", "layer")
