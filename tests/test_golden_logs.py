"""Golden cases: memory window, usage fold, embedding replies, SSE, skill
matching, front matter, URL dedupe, graph checks, policy."""

from tessera.operators import graph as G
from tessera.operators import joins as J
from tessera.operators import logs as LG
from tessera.operators import routing as R
from tessera.sources import files as S
from tests.conftest import rows


def _conv(spark, n):
    data = [(1, 0, "system", "sys")] + [(1, i, "user", f"Message {i}") for i in range(1, n + 1)]
    return spark.createDataFrame(data, "conv_id int, turn int, role string, text string")


def test_memory_window(spark):
    out = LG.memory_window(_conv(spark, 5), 4)
    assert sorted(r[0] for r in rows(out, "text")) == ["Message 3", "Message 4", "Message 5", "sys"]


def test_memory_clear(spark):
    assert rows(LG.memory_clear(_conv(spark, 3)), "text") == [("sys",)]


def test_usage_fold(spark):
    bodies = ['{"usage": {"prompt_tokens": 12, "completion_tokens": 34}}',
              '{"usage": {"input_tokens": 7, "output_tokens": 9}}',
              '{"usage": {"total_tokens": 50}}', "[1, 2]", '"text"', None,
              '{"usage": {"prompt_tokens": "7"}}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    out = rows(LG.usage_meter(df), "call_count", "llm_input_tokens", "llm_output_tokens", "embed_tokens")
    assert out == [(7, 19, 43, 50)]


def test_embeddings_reorder(spark):
    body = '{"data": [{"index": 1, "embedding": [0.3, 0.4]}, {"index": 0, "embedding": [0.1, 0.2]}], ' \
           '"model": "m", "usage": {"prompt_tokens": 7, "total_tokens": 7}}'
    out = LG.unwrap_embeddings(spark.createDataFrame([(body,)], "body string"))
    assert rows(out, "embeddings", "dimensions", "count", "tokens") == [([[0.1, 0.2], [0.3, 0.4]], 2, 2, 7)]


def test_sse_lines(spark):
    lines = ["event: pipeline_step", 'data: {"step":"search","status":"completed"}', "", "data: [DONE]"]
    df = spark.createDataFrame([(1, i, l) for i, l in enumerate(lines)], "stream_id int, line_no int, line string")
    out = rows(LG.parse_sse_lines(df), "type", "data")
    assert len(out) == 1 and out[0][0] == "pipeline_step" and '"search"' in out[0][1]


def test_sse_frames(spark):
    text = 'event: progress\ndata: {"a":\ndata: 1}\n\ndata: {"b": 2}\n\ndata: {"c"'
    out = rows(LG.parse_sse_frames(spark.createDataFrame([(1, text)], "stream_id int, text string")), "type", "data")
    assert [r[0] for r in out] == ["progress", "message"]


def test_skill_match(spark):
    rules = [{"name": "customer-support", "description": "help with orders"},
             {"name": "billing-help", "description": "help with orders"}]
    q = spark.createDataFrame([("help orders",), ("zzz",)], "text string")
    out = rows(R.skill_match(q, "text", rules), "skill")
    assert out == [("billing-help",), (None,)]


def test_frontmatter(spark):
    good = "---\r\nname: my-skill\r\ndescription: does things\r\n---\r\nbody"
    dup = "---\nname: my-skill\ndescription: again\n---\nx"
    bad = "---\nname: Bad Name\ndescription: d\n---\n"
    df = spark.createDataFrame([("a", good), ("b", dup), ("c", bad)], "path string, text string")
    out = {r[0]: r[1:] for r in rows(S.scan_frontmatter(df), "path", "name", "duplicate_name", "errors")}
    assert out["a"][0] == "my-skill" and out["a"][1] is True and out["a"][2] == []
    assert "name not kebab-case" in out["c"][2]


def test_url_dedupe(spark):
    data = [("q", 1, 1, 1, "u1"), ("q", 1, 1, 2, "u2"), ("q", 2, 1, 1, "u1")]
    df = spark.createDataFrame(data, "question string, iteration int, query_no int, pos int, url string")
    out = sorted(rows(J.gather_results(df), "url", "iteration"))
    assert out == [("u1", 1), ("u2", 1)]


def test_policy(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "tool string")
    out = {r[0]: r[1] for r in rows(R.policy_gate(df, blocked=["a"], allowed=["a", "b"]), "tool", "reason")}
    assert out == {"a": "tool a is blocked", "b": None, "c": "tool c is not allowed"}


def _graph(spark, nodes, edges):
    n = spark.createDataFrame([(1, i, t) for i, t in nodes], "graph int, id string, type string")
    e = spark.createDataFrame([(1, s, t) for s, t in edges], "graph int, source string, target string")
    return n, e


def test_graph_checks(spark):
    n, e = _graph(spark, [("a", "x"), ("b", "x"), ("b", "x"), ("c", "y"), ("d", "y")],
                  [("a", "b"), ("b", "zz"), ("qq", "a")])
    assert rows(G.duplicate_nodes(n), "id") == [("b",)]
    assert sorted(rows(G.dangling_edges(n, e), "side")) == [("source",), ("target",)]
    assert sorted(rows(G.disconnected_nodes(n, e), "id")) == [("c",), ("d",)]
    assert sorted(rows(G.restricted_nodes(n, ["y"]), "id")) == [("c",), ("d",)]


def test_graph_cycle_and_layers(spark):
    n, e = _graph(spark, [("a", "x"), ("b", "x"), ("c", "x"), ("d", "x")],
                  [("a", "b"), ("b", "c"), ("c", "b"), ("a", "d")])
    lay = dict(rows(G.topo_layers(n, e), "id", "layer"))
    assert lay == {"a": 0, "d": 1, "b": None, "c": None}
    assert rows(G.cyclic_graphs(n, e), "stuck_nodes") == [(2,)]
