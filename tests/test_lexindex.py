"""The stored lexical index against the direct search over the same documents."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import lexindex
from tessera.operators import retrieval as RT
from tessera.operators.lexindex import LexicalIndex

SCHEMA = "doc_id long, text string, lang string"


def corpus(seed=1, n=600):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(r.choices(words, weights, k=r.choice([0, 2, 9, 40]))), r.choice("abc")) for i in range(n)]
    docs += [(n + i, docs[5][1], "a") for i in range(30)] + [(n + 50, None, "b"), (n + 51, "Ñu, ñu! X2", None)]
    queries = [(i, " ".join(r.choices(words, k=r.choice([1, 3, 12])))) for i in range(20)] + [(30, ""), (31, None), (32, "unheard"), (33, "ñu x2"), (34, docs[5][1])]
    return docs, queries


def found(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 7)) for r in df.collect())


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(lexindex, "CELL", 16)
    monkeypatch.setattr(lexindex, "GROUP_DOCS", 64)


def test_equals_direct_search_through_additions_and_removals(spark, tmp_path, small):
    docs, queries = corpus()
    q = spark.createDataFrame(queries, "query_id long, text string")
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    ix = LexicalIndex.create(spark, str(tmp_path / "ix"), buckets=4)
    assert ix.search(q).count() == 0
    ix.add(df(docs[:400]), collection="lang")
    files = {p for e in ix._postings.manifest()["entries"].values() for p in e["data"]}
    ix.add(df(docs[400:]), collection="lang", writer=("w", 1))
    ix.add(df(docs[400:]), collection="lang", writer=("w", 1))  # repeated: nothing happens
    assert files < {p for e in ix._postings.manifest()["entries"].values() for p in e["data"]}  # nothing rewritten
    assert found(ix.search(q)) == found(RT.bm25_search(q, df(docs)))
    changed = [(i, f"w1 w7 w{i}", "c") for i in range(0, 600, 7)]
    ix.add(df(changed), collection="lang")  # replaced documents
    ix.remove(spark.createDataFrame([(i,) for i in [*range(3, 600, 5), 9999]], "id long"))
    now = {d[0]: d for d in docs} | {d[0]: d for d in changed}
    now = [d for i, d in now.items() if not (i < 600 and i % 5 == 3)]
    again = LexicalIndex.open(spark, str(tmp_path / "ix"))
    assert found(again.search(q, k=7)) == found(RT.bm25_search(q, df(now), k=7))
    want = RT.bm25_search(q, df(now).where("lang IN ('a', 'b')"))
    assert found(again.search(q, collections=["a", "b"])) == found(want)
    assert again.search(q, collections=[]).count() == 0
    parts = {x: df(now).where(F.col("lang") == x) for x in "abc"}
    cols = ["query_id", "rank", "collection", "id"]
    many = again.search(q, collections=["a", "b", "c"], per_collection=True)
    assert sorted(map(tuple, many.select(cols).collect())) == sorted(map(tuple, RT.search_many(q, parts).select(cols).collect()))


def test_few_postings_are_read(spark, tmp_path, small):
    """One rare term that few documents hold makes the lists of the common ones needless beyond their cells."""
    docs = [(i, " ".join(["common"] * (1 + i % 3) + [f"x{j}" for j in range(i % 50)]) + (" rare rare" if i in (40, 700, 1501) else ""), "a") for i in range(2000)]
    ix = LexicalIndex.create(spark, str(tmp_path / "ix"), buckets=2)
    ix.add(spark.createDataFrame(docs, SCHEMA).repartition(4))
    q = spark.createDataFrame([(1, "rare common")], "query_id long, text string")
    share = ix.read_share(q, k=3).collect()[0]
    assert share["postings"] == 2003 and share["scored"] < 600
    assert found(ix.search(q, k=3)) == found(RT.bm25_search(q, spark.createDataFrame(docs, SCHEMA), k=3))


def test_failed_addition_is_not_seen(spark, tmp_path, small, monkeypatch):
    docs, queries = corpus()
    q = spark.createDataFrame(queries, "query_id long, text string")
    ix = LexicalIndex.create(spark, str(tmp_path / "ix"), buckets=2)
    ix.add(spark.createDataFrame(docs[:200], SCHEMA))
    monkeypatch.setattr(LexicalIndex, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        ix.add(spark.createDataFrame(docs[200:300], SCHEMA))
    monkeypatch.undo()
    ix = LexicalIndex.open(spark, str(tmp_path / "ix"))
    assert found(ix.search(q)) == found(RT.bm25_search(q, spark.createDataFrame(docs[:200], SCHEMA)))
    ix.add(spark.createDataFrame(docs[300:], SCHEMA))  # goes on from the version that is seen
    assert found(ix.search(q)) == found(RT.bm25_search(q, spark.createDataFrame(docs[:200] + docs[300:], SCHEMA)))
