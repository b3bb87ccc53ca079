"""Embedding by a dictionary of words, and an index search that holds a bounded number of candidates."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import vecindex as VX
from tessera.operators import vectors as V


def test_embedding_equals_the_column_form(spark):
    texts = ["", None, "Alpha beta, beta! ÄÖ ß 7", "  ", "x " * 500 + "y", "İstanbul ﬁne ∑ a_b"] + [f"w{i} w{i % 3} alpha" for i in range(90)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    for dims in (1, 7, 64):
        got = {r["id"]: r["embedding"] for r in V.embed(df, dims=dims).collect()}
        for r in df.select("id", V.signed_buckets(F.col("text"), dims).alias("s")).collect():
            v = np.zeros(dims)
            for x in r["s"] or []:
                v[abs(x) - 1] += np.sign(x)
            n = np.linalg.norm(v)
            assert got[r["id"]] == (v / n if n > 0 else v).astype(np.float32).tolist()
    plan = V.embed(df)._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan  # each word of a slice is hashed once, in the task
    assert V.embed(df.limit(0)).count() == 0


def test_candidates_leave_a_task_in_bounded_parts(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(1)
    base = r.normal(size=(20, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, base[i % 20].tolist()) for i in range(4000)], "id long, embedding array<float>")  # 200 copies of each
    ix = VX.VectorIndex.create(spark, str(tmp_path / "v"), df, lists=6, buckets=2)
    ix.add(df)
    q = df.where("id < 40").withColumnRenamed("id", "query_id")
    want = sorted(map(tuple, V.vector_search(q, df, 3).select("query_id", "rank", "id", "score").collect()))
    monkeypatch.setattr(VX, "SCORE_CELLS", 400)
    monkeypatch.setattr(VX, "TASK_ROWS", 64)
    got = sorted(map(tuple, ix.search(q, 3, probes=100).select("query_id", "rank", "id", "score").collect()))
    assert got == want
