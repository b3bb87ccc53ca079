"""Invariants for operators without a SQL twin, on the small test tables."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import ordering as O
from tessera.operators import text as TX
from tessera.operators import vectors as V
from tessera.session import Tables
from tests.conftest import SF001, rows


def test_chunk_fixed_rejoins_source(spark):
    docs = Tables(spark, SF001).documents.select("doc_id", "text")
    ch = TX.chunk_fixed(docs, "text", 100, 20)
    # dropping each chunk's overlap and concatenating gives back the text
    rebuilt = ch.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk"))).alias("c")).select(
        "doc_id", F.aggregate("c", F.lit(""), lambda acc, x: F.concat(
            acc, F.when(x["chunk_no"] == 0, x["chunk"]).otherwise(F.substring(x["chunk"], 21, 1 << 20)))).alias("t"))
    bad = rebuilt.join(docs, "doc_id").filter(F.col("t") != F.col("text")).count()
    assert bad == 0


def test_chunk_recursive_bounds(spark):
    docs = Tables(spark, SF001).documents.select("doc_id", "text")
    ch = TX.chunk_recursive(docs, "text", 200, 20)
    assert ch.filter(F.length("chunk") > 220).count() == 0
    assert ch.select("doc_id").distinct().count() == docs.filter(F.length("text") > 0).count()


def test_positions_exact_under_skew(spark):
    # one key holds almost everything: positions stay exact and dense
    df = spark.range(5000).withColumn("k", F.when(F.col("id") < 4900, F.lit(0)).otherwise(F.col("id") % 7))
    p = O.positions(df, ["k"], ["id"], num_partitions=8)
    got = p.groupBy("k").agg(F.count("*").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                             F.count_distinct("pos").alias("d"))
    for k, n, lo, hi, d in rows(got):
        assert lo == 0 and hi == n - 1 and d == n
    hot = p.filter("k = 0 and id = 4899").select("pos").first()[0]
    assert hot == 4899


def test_carry_forward_across_partitions(spark):
    df = spark.range(1000).withColumn("k", F.lit(1)).withColumn(
        "m", F.when(F.col("id") % 250 == 0, F.col("id").cast("string")))
    c = O.carry_forward(df, ["k"], ["id"], "m", "last", include_current=True, num_partitions=8)
    wrong = c.filter(F.col("last") != (F.floor(F.col("id") / 250) * 250).cast("string")).count()
    assert wrong == 0


def test_embed_is_unit_length(spark):
    docs = Tables(spark, SF001).documents.select("doc_id", "text")
    e = V.embed(docs, "text", 64, id_col="doc_id")
    norms = [r[0] for r in rows(e.select(V.norm(F.col("embedding"))))]
    assert all(abs(n - 1.0) < 1e-5 or n == 0.0 for n in norms)


def test_vector_search_matches_brute_force(spark):
    emb = Tables(spark, SF001).embeddings
    corpus = emb.select(F.col("vec_id").alias("id"), "embedding")
    queries = emb.limit(3).select(F.col("vec_id").alias("query_id"), "embedding")
    got = sorted(rows(V.vector_search(queries, corpus, k=5), "query_id", "id"))
    m = np.array([r[1] for r in rows(corpus)], dtype=np.float64)
    ids = [r[0] for r in rows(corpus)]
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = []
    for qid, qv in rows(queries):
        q = np.asarray(qv, dtype=np.float64)
        s = np.round(m @ (q / np.linalg.norm(q)), 9)
        order = sorted(range(len(ids)), key=lambda i: (-s[i], ids[i]))[:5]
        want += [(qid, ids[i]) for i in order]
    assert got == sorted(want)


def test_kmeans_centroid_count(spark):
    emb = Tables(spark, SF001).embeddings
    _, cents = V.cluster(emb, k=3, seed=2)
    assert len(cents) == 3


def test_ridge_recovers_known_map(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6))
    w = rng.normal(size=(6, 6))
    y = x @ w
    df = spark.createDataFrame([(i, x[i].tolist(), y[i].tolist()) for i in range(300)], "id int, source array<double>, target array<double>")
    assert np.abs(V.fit_ridge(df, 1e-9) - w).max() < 1e-4
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    df2 = spark.createDataFrame([(i, x[i].tolist(), (x[i] @ q).tolist()) for i in range(300)], "id int, source array<double>, target array<double>")
    assert np.abs(V.fit_procrustes(df2) - q).max() < 1e-6
    assert V.cka(df2) > 0.999


def test_quantize_error_bound(spark):
    emb = Tables(spark, SF001).embeddings
    q, rng = V.quantize_sq8(emb)
    width = max(r["hi"] - r["lo"] for r in rng.collect())
    err = q.select(F.array_max(F.zip_with("restored", "embedding", lambda a, b: F.abs(a - b)))).agg(F.max("*")).first()[0]
    assert err <= width / 255 / 2 + 1e-6


def test_html_parse(spark):
    pages = Tables(spark, SF001).pages
    out = TX.parse_html(pages, "html", "page_id")
    r = out.filter(F.length("title") > 0).count()
    assert r == pages.count()
    assert out.filter(F.col("text").contains("<script")).count() == 0


def test_citations_found(spark):
    t = Tables(spark, SF001)
    v = TX.verify_citations(t.benchmark.select(F.col("item_id").alias("cite_id"), "text"), t.documents.select("doc_id", "text"))
    brute = t.benchmark.alias("b").join(t.documents.alias("d"), F.col("d.text").contains(F.col("b.text"))) \
        .select("b.item_id").distinct().count()
    assert v.filter("found").count() == brute


def test_hot_conversation_window_and_top_k(spark):
    # one conversation holds most rows: results stay exact
    n = 6000
    conv = spark.range(n).select(F.when(F.col("id") < 5000, F.lit(1)).otherwise(F.col("id") % 50 + 2).alias("conv_id"),
                                 F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, F.lit("system")).otherwise(F.lit("user")).alias("role"),
                                 F.col("id").cast("string").alias("text"))
    from tessera.operators import logs as LG

    w = LG.memory_window(conv, 10).filter("conv_id = 1")
    got = sorted(r[0] for r in rows(w, "turn"))
    assert got == [0] + list(range(4991, 5000))
    top = O.top_k(conv, ["conv_id"], "turn", 3)
    assert sorted(r[0] for r in rows(top.filter("conv_id = 1"), "turn")) == [4997, 4998, 4999]
