"""Cases beyond the small one: deep graphs, long front matter, number and regex rules."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.jsvalues import js_number
from tessera.operators import filters, graph, retrieval, vectors
from tessera.sources import files


def test_layers_have_no_round_limit(spark):
    n = 12
    nodes = spark.createDataFrame([("g", str(i)) for i in range(n)], "graph string, id string")
    edges = spark.createDataFrame([("g", str(i), str(i + 1)) for i in range(n - 1)], "graph string, source string, target string")
    assert {r["id"]: r["layer"] for r in graph.topo_layers(nodes, edges).collect()} == {str(i): i for i in range(n)}
    assert graph.cyclic_graphs(nodes, edges).count() == 0
    loop = edges.union(spark.createDataFrame([("g", "11", "9")], edges.schema))
    assert [(r["graph"], r["stuck_nodes"]) for r in graph.cyclic_graphs(nodes, loop).collect()] == [("g", 3)]


def test_numbers_as_in_js(spark):
    df = spark.createDataFrame([("NaN",), ("0x10",), ("0b11",), ("1e3",), (" 7 ",), ("",), ("-Infinity",), ("1d",), ("x",), (None,)], "v string")
    got = [r[0] for r in df.select(js_number(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [None, 16.0, 3.0, 1000.0, 7.0, 0.0, float("-inf"), None, None, None]


def test_named_groups_are_valid():
    assert filters.valid_regex(r"(?<year>\d{4})-\k<year>") and filters.valid_regex("(?<=a)b") and not filters.valid_regex("(")


def test_versions_with_equal_times(spark):
    df = spark.createDataFrame([("e", 1, 5), ("e", 2, 5), ("e", 3, 4)], "entity string, id int, event_time long")
    assert [r["id"] for r in filters.temporal_filter(df, "latest", entity="entity", tie="id").collect()] == [2]


def test_long_front_matter_value(spark):
    value = "v" * ((1 << 20) + 10)
    df = spark.createDataFrame([(f"---\nname: a\ndescription: {value}\n---\nbody",)], "text string")
    fn = files.frontmatter if hasattr(files, "frontmatter") else files.scan_frontmatter
    assert any(value in str(v) for v in fn(df).first())


def brute_best(scores, ids, k, least=-np.inf):
    return {(q, i, s) for q, col in enumerate(scores.T) for s, i in sorted(((s, i) for s, i in zip(col, ids) if s >= least),
                                                                           key=lambda x: (-x[0], x[1]))[:k]}


def test_running_best_over_blocks():
    random = np.random.default_rng(5)
    scores = random.integers(-3, 4, (200, 7)) / 2  # many ties
    for ids in (random.permutation(200), np.array([f"d{i}" for i in random.permutation(200)], dtype=object)):
        for least in (-np.inf, 0.5):
            best = vectors.Best(7, 6, least)
            for at in (0, 3, 90, 91, 140):
                end = {0: 3, 3: 90, 90: 91, 91: 140, 140: 200}[at]
                best.add(ids[at:end], scores[at:end])
            got = set(zip(best.q.tolist(), best.ids.tolist(), best.s.tolist()))
            assert got == brute_best(scores, ids.tolist(), 6, least)


def test_exact_search_in_blocks_and_slices(spark, monkeypatch):
    random = np.random.default_rng(6)
    data = random.normal(size=(60, 8))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id int, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(data[:9] + 0.1)], "query_id string, embedding array<double>")
    want = {(r["query_id"], r["id"], r["rank"]) for r in vectors.block_topk(corpus, queries, 4).collect()}
    unit = vectors.unit_rows(data)
    q = vectors.unit_rows(data[:9] + 0.1)
    assert want == {(str(j), int(i), n + 1) for j in range(9) for n, i in enumerate(np.argsort(-(unit @ q[j]))[:4])}
    monkeypatch.setattr(vectors, "QUERY_BATCH_ROWS", 4)
    monkeypatch.setattr(vectors, "SCORE_CELLS", 20)
    assert {(r["query_id"], r["id"], r["rank"]) for r in vectors.block_topk(corpus, queries, 4).collect()} == want
    assert vectors.block_topk(corpus, queries.limit(0), 4).count() == 0 and vectors.block_topk(corpus.limit(0), queries, 4).count() == 0


def test_lexical_search_in_blocks(spark, monkeypatch):
    random = np.random.default_rng(7)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(random.choice(words, random.integers(0, 25)))) for i in range(50)] + [(50, None)]
    asks = [(i, " ".join(random.choice(words, 4))) for i in range(8)] + [(8, "")]
    toks = {i: (t or "").split() for i, t in docs}
    df = Counter(w for t in toks.values() for w in set(t))
    avg = sum(map(len, toks.values())) / len(toks)
    want = set()
    for q, text in asks:
        sums = {}
        for i, t in toks.items():
            c = Counter(t)
            s = sum(math.log(1 + (len(toks) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * len(t) / avg)) for w in set(text.split()))
            if s > 0:
                sums[i] = round(s, 9)
        want |= {(q, i, n + 1) for n, i in enumerate(sorted(sums, key=lambda i: (-sums[i], i))[:5])}
    corpus = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    queries = spark.createDataFrame(asks, "query_id int, text string")
    found = lambda: {(r["query_id"], r["id"], r["rank"]) for r in retrieval.bm25_search(queries, corpus, 5).collect()}
    assert found() == want
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    monkeypatch.setattr(retrieval, "SCORE_CELLS", 40)
    assert found() == want


def test_inverted_file_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    corpus = e.select(F.col("vec_id").alias("id"), "embedding")
    queries = e.where("vec_id % 5 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = {(r["query_id"], r["id"]) for r in vectors.block_topk(corpus, queries, 10).collect()}
    near = vectors.ann_search(queries, corpus, 10).collect()
    assert len({(r["query_id"], r["id"]) for r in near} & exact) >= 0.9 * len(exact)
    assert {n for n in Counter(r["query_id"] for r in near).values()} == {10}  # always filled up to k
    every = vectors.ann_search(queries, corpus, 10, probes=10 ** 6, lists=5).collect()
    assert {(r["query_id"], r["id"]) for r in every} == exact


def test_few_lists_where_vectors_cluster():
    random = np.random.default_rng(8)
    centres = vectors.unit_rows(random.normal(size=(40, 16)))
    rows = vectors.unit_rows(np.repeat(centres, 50, axis=0) + random.normal(size=(2000, 16)) / 30)
    rows = rows[random.permutation(len(rows))]
    assert vectors._lists_to_open(rows, centres, 10, 0.95) == 1
    noise = vectors.unit_rows(random.normal(size=(2000, 16)))
    assert vectors._lists_to_open(noise, centres, 10, 0.95) > 4


def test_context_keeps_its_budget(spark):
    rows = [(q, i, "x" * n) for q, sizes in (("a", (10, 30, 60, 40)), ("b", (200,)), ("c", (78,)), ("d", (0, 4))) for i, n in enumerate(sizes, 1)]
    hits = spark.createDataFrame(rows, "query_id string, rank int, text string")
    packed = {r["query_id"]: r for r in retrieval.pack_context(hits, 20).collect()}
    assert all(math.ceil(len(r["context"]) / 4) <= r["tokens_used"] <= 20 for r in packed.values())
    assert packed["a"]["context"] == "[1] " + "x" * 10 + "\n\n[2] " + "x" * 30 + "\n\n[3] " + "x" * 22
    assert [packed["a"][c] for c in ("tokens_used", "n_included", "n_truncated", "n_skipped")] == [20, 2, 1, 1]
    assert (packed["b"]["n_truncated"], len(packed["b"]["context"])) == (1, 80)
