"""What a task holds in Python does not grow with the batches that Spark sends; results stay."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import lexindex as LX
from tessera.operators import retrieval as RT
from tessera.operators import text as TX
from tessera.operators import vectors as V
from tessera.session import SLICE_ROWS, arrow_slices


def test_slices_cover_each_batch():
    b = pa.RecordBatch.from_arrays([pa.array(range(1000))], ["x"])
    parts = list(arrow_slices([b, b.slice(0, 0), b.slice(5, 3)]))
    assert max(p.num_rows for p in parts) == SLICE_ROWS
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(1000), 5, 6, 7]


def _docs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words, n)) + rng.choice([". ", "! ", "\n"])
    rows = [(i, "".join(text(int(rng.integers(1, 9))) for _ in range(int(rng.integers(0, 12)))), "ab"[i % 2]) for i in range(700)]
    return spark.createDataFrame([*rows, (700, None, "a"), (701, "", None), (5, rows[5][1], "b"), (None, "w1 w2. w1 w2. w9", "a"), (None, None, "b")],
                                 "doc_id long, text string, lang string")


def test_semantic_chunks_equal_the_column_form(spark):
    docs = _docs(spark)
    got = TX.chunk_semantic(docs, threshold=0.2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1  # texts are shuffled once, vectors never
    # vectors and cosines by column functions, chunks by windows
    s = TX.sentences(docs).withColumn("_sid", F.concat_ws(":", F.col("doc_id").cast("string"), "sent_no"))
    w = Window.partitionBy("doc_id").orderBy("sent_no")
    cut = V.embed(s, "sentence", id_col="_sid").withColumn("_prev", F.lag("embedding").over(w)).withColumn(
        "_cut", F.when(F.col("_prev").isNull(), 1).when(V.cosine(F.col("embedding"), F.col("_prev")) < 0.2, 1).otherwise(0))
    g = cut.withColumn("chunk_no", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).groupBy("doc_id", "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("sent_no", "sentence"))).alias("_s"))
    want = g.select("doc_id", "chunk_no", F.array_join(F.transform("_s", lambda x: x["sentence"]), " ").alias("chunk"), F.size("_s").alias("n_sentences"))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_recursive_chunks_by_slices(spark):
    docs = _docs(spark).coalesce(1)
    got = sorted(map(str, TX.chunk_recursive(docs, size=60, overlap=10).collect()))
    want = sorted(str((r["doc_id"], k, c)) for r in docs.collect() for k, c in enumerate(TX.recursive_chunks(r["text"] or "", 60, 10)))
    assert sorted(str(tuple(r)) for r in TX.chunk_recursive(docs, size=60, overlap=10).collect()) == want and len(got) == len(want)


def test_index_by_small_blocks_equals_search(spark, tmp_path, monkeypatch):
    docs = _docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    q = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w30 w1"), (3, "none"), (4, "w7")], "query_id long, text string")
    want = sorted(map(tuple, RT.bm25_search(q, docs, 5).collect()))
    for name, value in (("CELL", 64), ("GROUP_DOCS", 100), ("SCORE_CELLS", 500)):
        monkeypatch.setattr(LX, name, value)
    monkeypatch.setattr(RT, "SCORE_CELLS", 500)
    ix = LX.LexicalIndex.create(spark, str(tmp_path / "ix"))
    ix.add(docs, collection="lang")
    assert ix._table("cells").select("cell").distinct().count() == ix._table("cells").count()
    assert sorted(map(tuple, ix.search(q, 5).collect())) == want == sorted(map(tuple, RT.bm25_search(q, docs, 5).collect()))
