"""Cycles by strongly connected components, against Tarjan-free brute force (reachability sets)."""

import random

import pytest

from tessera.operators import graph as G


@pytest.fixture(autouse=True)
def few_tasks(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", was)


def tables(spark, graphs):
    nodes = [(g, n, "t") for g, (ns, _) in graphs.items() for n in ns]
    edges = [(g, a, b) for g, (_, es) in graphs.items() for a, b in es]
    return (spark.createDataFrame(nodes, "graph string, id long, type string").repartition(2),
            spark.createDataFrame(edges, "graph string, source long, target long").repartition(2))


def reach(ns, es):
    ns = set(ns)
    out = {n: {b for a, b in es if a == n and b in ns} for n in ns}
    while True:
        new = {n: r | {y for x in r for y in out[x]} for n, r in out.items()}
        if new == out:
            return out
        out = new


def expected(graphs):
    on, stuck = set(), set()
    for g, (ns, es) in graphs.items():
        r = reach(ns, es)
        cyclic = {n for n in r if n in r[n]}
        for n in cyclic:
            on.add((g, n, frozenset(m for m in cyclic if m in r[n] and n in r[m])))
        stuck |= {(g, n) for n in r if n in cyclic or any(n in r[c] for c in cyclic)}
    return on, stuck


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(G, "WALK_ROWS", 40)  # some walks are doubled, and give way to single steps when they grow
    monkeypatch.setattr(G, "WALK_FACTOR", 1)
    r = random.Random(5)
    graphs = {f"g{i}": (list(range(k := r.randint(1, 7))), [(r.randrange(k), r.randrange(k + 1)) for _ in range(r.randint(0, 9))]) for i in range(12)}
    graphs["loop"] = ([1, 2], [(1, 1), (1, 2)])
    graphs["two"] = (list(range(8)), [(0, 1), (1, 0), (1, 2), (2, 3), (3, 4), (4, 3), (4, 5), (6, 0), (7, 7)])
    graphs["none"] = ([1, 2, 3], [(1, 2), (2, 3), (1, 3)])
    n, e = tables(spark, graphs)
    on, stuck = expected(graphs)
    got = G.strong_components(n, e).collect()
    members = {}
    for x in got:
        members.setdefault((x["graph"], x["component"]), set()).add(x["id"])
    assert {(x["graph"], x["id"], frozenset(members[x["graph"], x["component"]])) for x in got} == on
    assert all(x["size"] == len(members[x["graph"], x["component"]]) for x in got)
    every = G.cycle_nodes(n, e).collect()
    assert {(x["graph"], x["id"]) for x in every} == stuck
    assert {(x["graph"], x["id"]) for x in every if x["on_cycle"]} == {(g, i) for g, i, _ in on}


def test_long_chain_needs_few_rounds(spark, monkeypatch):
    cuts = []
    cut = G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    k = 5000
    assert G.cyclic_graphs(*tables(spark, {"chain": (list(range(k)), [(i + 1, i) for i in range(k - 1)])})).count() == 0
    assert len(cuts) < 75  # three tables a round, two times log2(5000) rounds at most
    k = 60
    ring = {"ring": (list(range(k)), [(i + 1, i) for i in range(k - 1)] + [(0, k - 1)])}
    got = [(x["cycle_nodes"], x["stuck_nodes"], x["knots"]) for x in G.cyclic_graphs(*tables(spark, ring)).collect()]
    assert got == [(k, k, 1)]


def test_empty(spark):
    n, e = tables(spark, {"a": ([1], [(1, 2)])})
    assert G.cyclic_graphs(n, e).count() == 0
    assert G.strong_components(n.limit(0), e).count() == 0
