"""The stored inverted file against exact search."""

import numpy as np
import pytest

from tessera.operators import vectors as V
from tessera.operators.vecindex import VectorIndex

SCHEMA = "id long, embedding array<float>"


def clustered(n=4000, groups=40, dims=16, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dims)) * 4
    return [(i, (centres[i % groups] + r.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


def hits(df):
    return {(r["query_id"], r["rank"], r["id"], round(r["score"], 7)) for r in df.collect()}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = clustered()
    df = spark.createDataFrame(rows, SCHEMA)
    ix = VectorIndex.create(spark, str(tmp_path_factory.mktemp("ix") / "v"), df)
    ix.add(df.where("id < 2500"))
    ix.add(df.where("id >= 2500"), writer=("w", 1))
    ix.add(df.where("id >= 2500"), writer=("w", 1))  # repeated: nothing happens
    return rows, ix


def test_recall_and_rows_read(spark, index):
    rows, ix = index
    df = spark.createDataFrame(rows, SCHEMA)
    q = df.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    exact, got = hits(V.vector_search(q, df)), hits(ix.search(q))
    assert len({(a, c) for a, _, c, _ in got} & {(a, c) for a, _, c, _ in exact}) >= 0.9 * len(exact)
    share = ix.rows_read(q).collect()
    assert len(share) == 80 and np.mean([r["share"] for r in share]) < 0.1


def test_all_lists_give_the_exact_result(spark, index):
    rows, ix = index
    df = spark.createDataFrame(rows, SCHEMA)
    q = df.where("id % 400 = 7").withColumnRenamed("id", "query_id")
    assert hits(ix.search(q, probes=10_000)) == hits(V.vector_search(q, df))


def test_replaced_and_removed(spark, tmp_path):
    rows = clustered(600, 10, 8, 3)
    odd = [(9000, None), (9001, [1.0, 2.0]), (9002, [float("nan")] * 8), (9003, [0.0] * 8)] + [(9100 + i, rows[3][1]) for i in range(30)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    path = str(tmp_path / "v")
    ix = VectorIndex.create(spark, path, df, lists=12, buckets=4)
    ix.add(df)
    moved = [(i, rows[(i + 1) % 600][1]) for i in range(0, 600, 6)]
    ix.add(spark.createDataFrame(moved, SCHEMA))
    ix.remove(spark.createDataFrame([(i,) for i in [*range(1, 600, 5), 77_777]], "id long"))
    now = dict(rows) | dict(odd[3:]) | dict(moved)
    now = [(i, v) for i, v in now.items() if i >= 600 or i % 5 != 1]
    ix = VectorIndex.open(spark, path)
    q = spark.createDataFrame([(1, rows[0][1]), (2, rows[3][1]), (3, [0.0] * 8), (4, None)], "query_id long, embedding array<float>")
    want = hits(V.vector_search(q.where("query_id < 4"), spark.createDataFrame(now, SCHEMA), k=40))
    assert hits(ix.search(q, k=40, probes=100)) == want
    assert sum(ix.manifest["sizes"].values()) == len(now)
    assert ix.search(q.limit(0)).count() == 0


def test_no_vectors(spark, tmp_path):
    with pytest.raises(ValueError):
        VectorIndex.create(spark, str(tmp_path / "v"), spark.createDataFrame([(1, None)], SCHEMA))
