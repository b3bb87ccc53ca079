"""Frontier expansion and the graph among a query's nodes, against plain walks."""

import random

from tessera.operators import joins as J


def walk(hits, edges, hops, cap):
    near = {}
    for s, t, rel, w in edges:
        near.setdefault(s, []).append((-w, t, rel, "outgoing"))
        near.setdefault(t, []).append((-w, s, rel, "incoming"))
    near = {n: {x[1] for x in sorted(v)[:cap]} for n, v in near.items()}
    out = {}
    for q, start in hits:
        out.setdefault((q, start), 0)
    for hop in range(1, hops + 1):
        for (q, n), h in list(out.items()):
            if h == hop - 1:
                for m in near.get(n, ()):
                    out.setdefault((q, m), hop)
    return out


def test_hops_and_subgraph(spark):
    r = random.Random(3)
    edges = list({(f"n{r.randrange(40)}", f"n{r.randrange(40)}", "r"): 0 for _ in range(90)}) + [("hub", f"n{i}", "r") for i in range(40)]
    edges = [(*e, round(r.random(), 2)) for e in edges]
    hits = [(q, n) for q in range(30) for n in (["hub"] if q % 3 == 0 else []) + [f"n{r.randrange(40)}"]] + [(99, "nowhere")]
    e = spark.createDataFrame(edges, "source string, target string, relation string, weight double")
    h = spark.createDataFrame(hits + hits[:5], "query_id long, id string")
    for hops, cap in ((0, 2), (1, 3), (2, 2), (3, 2)):
        got = {(x["query_id"], x["id"]): x["hop"] for x in J.expand_hops(h, e, hops, cap=cap).collect()}
        assert got == walk(hits, edges, hops, cap)
    nodes = set(walk(hits, edges, 2, 2))
    sub = J.hit_subgraph(J.expand_hops(h, e, 2, cap=2), e)
    want = sorted((q, s, t, rel, w) for s, t, rel, w in edges for q in {q for q, _ in nodes} if (q, s) in nodes and (q, t) in nodes)
    assert sorted(tuple(x) for x in sub.select("query_id", "source", "target", "relation", "weight").collect()) == want
