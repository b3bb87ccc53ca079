"""Golden cases for sources: upsert precedence, delete, ingest stamp,
metadata limits, vector text import."""

from pyspark.sql import functions as F

from tessera.sources import files as S
from tests.conftest import rows


def test_upsert_versions_and_documents_win(spark):
    target = spark.createDataFrame([("a", 1, False, "old"), ("b", 1, False, "old")],
                                   "id string, version int, has_document boolean, v string")
    updates = spark.createDataFrame([("a", 2, False, "new"), ("b", 0, False, "stale"), ("c", 1, False, "add")],
                                    "id string, version int, has_document boolean, v string")
    got = dict(rows(S.upsert(target, updates, "id", version_col="version"), "id", "v"))
    assert got == {"a": "new", "b": "old", "c": "add"}
    docs = spark.createDataFrame([("a", 5, True, "doc")], "id string, version int, has_document boolean, v string")
    vecs = spark.createDataFrame([("a", 9, False, "vec")], "id string, version int, has_document boolean, v string")
    got2 = dict(rows(S.upsert(docs, vecs, "id", version_col="version", prefer_col="has_document"), "id", "v"))
    assert got2 == {"a": "doc"}


def test_delete_by_key(spark):
    t = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    ids = spark.createDataFrame([("b",), ("b",), ("z",)], "id string")
    assert sorted(rows(S.delete_by_key(t, ids))) == [("a",), ("c",)]


def test_ingest_stamp_merges_metadata(spark):
    df = spark.createDataFrame([(1,)], "doc_id int").withColumn("metadata", F.create_map(F.lit("team"), F.lit("old"), F.lit("k"), F.lit("v")))
    out = S.ingest_upload(df, "bkt", "col", {"team": "growth", "week": 18, "flag": True})
    (b, c, m), = rows(out, "bucket", "collection", "metadata")
    assert (b, c) == ("bkt", "col") and m == {"k": "v", "team": "growth", "week": "18", "flag": "true"}


def test_metadata_limits(spark):
    big = {f"k{i}": "v" for i in range(40)}
    cases = [({"ok_key": "v"}, []), ({"bad key": "v"}, ["bad key characters"]), ({"text": "v"}, ["reserved key"]),
             ({"x" * 65: "v"}, ["key longer than 64"]), ({"k": "v" * 600}, ["value longer than 512"])]
    for meta, want in cases:
        df = spark.createDataFrame([(meta,)], "metadata map<string,string>")
        assert rows(S.validate_metadata(df), "errors")[0][0] == want, meta
    df = spark.createDataFrame([(big,)], "metadata map<string,string>")
    assert "more than 32 keys" in rows(S.validate_metadata(df), "errors")[0][0]


def test_vector_text_import(spark):
    df = spark.createDataFrame([(7, "[0.5, -1.25,2]")], "id int, v string")
    assert rows(S.vectors_from_text(df, "id", "v")) == [("7", [0.5, -1.25, 2.0])]


def test_every_export_layout(spark, tmp_path):
    files = {
        "pgvector": 'a\t[1, -2.5]\t{"k": 1}\nb\t[3]\n\t[1]\nc\t[1,x]\nd\n\n',
        "pinecone": '{"id": "a", "values": [1, -2.5], "metadata": {"k": 1}}\n{"id": "b", "values": [3]}\n{"values": [1]}\n{"id": "c", "values": [1, "x"]}\n{"id": "d"}\nnot json\n',
        "weaviate": '{"id": "a", "class": "C", "vector": [1, -2.5], "properties": {"k": 1}}\n{"id": "b", "vector": [3]}\n{"vector": [1]}\n{"id": "d", "vector": []}\n',
        "chroma": '{"ids": ["a", "b"], "embeddings": [[1, -2.5], [3]], "metadatas": [{"k": 1}, null]}\n{"ids": ["c"], "embeddings": []}\n{"ids": ["d"], "embeddings": [[]]}\n',
    }
    for layout, text in files.items():
        (tmp_path / layout).write_text(text)
        got = rows(S.import_vectors(spark, str(tmp_path / layout), layout), "id", "vector", "metadata", "error")
        good = sorted(r for r in got if r[3] is None)
        assert good == [("a", [1.0, -2.5], {"k": "1"}, None), ("b", [3.0], {}, None)], layout
        bad = [r for r in got if r[3] is not None]
        assert len(bad) == sum(1 for line in text.split("\n") if line.strip()) - (1 if layout == "chroma" else 2) and all(r[1] is None for r in bad), layout
        assert {r[3] for r in bad} == {"no id", "no vector of numbers"}, layout


def test_collections_are_pruned(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(30)], "id int, lang string")
    S.write_collection(S.ingest_upload(df, "b", F.col("lang")), path)
    part = spark.read.parquet(path).where("bucket = 'b' AND collection = 'a'")
    assert part.count() == 10 and len(part.inputFiles()) > 0
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "collection" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_exports_read_back(spark, tmp_path):
    data = [("a", "one\ntwo\r\n\nthree"), ("b\nb", "back\\slash \\n \\\\n \\"), ("c", "page\n\f\nbreak \\f"), ("d", ""), ("", "é # x\n# y"), ("f", None)]
    df = spark.createDataFrame(data, "id string, answer string").repartition(2)
    want = sorted((i, t or "") for i, t in data)
    S.export_answers(df, str(tmp_path / "md"), "markdown", id_col="id")
    assert sorted(rows(S.read_answers(spark, str(tmp_path / "md"), "markdown"), "id", "answer")) == want
    S.export_answers(df, str(tmp_path / "txt"), "text")
    assert sorted(r[0] for r in rows(S.read_answers(spark, str(tmp_path / "txt"), "text"))) == sorted(t for _, t in want)


def test_newest_rows_do_not_depend_on_order(spark):
    from tessera.operators import filters as FL

    data = [("e", 5, f"v{i}", {"k": str(i)}) for i in range(20)] + [("f", 1, "x", None)]
    got = set()
    for n in (1, 3, 7):
        df = spark.createDataFrame(data, "entity string, t int, v string, m map<string,string>").repartition(n)
        got.add(tuple(sorted((r["entity"], r["v"]) for r in FL.temporal_filter(df, "latest", "t", entity="entity").collect())))
    assert got == {(("e", "v9"), ("f", "x"))}
