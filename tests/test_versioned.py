"""The versioned table against a dict of documents."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import versioned
from tessera.sources.versioned import Conflict, VersionedTable

SCHEMA = "doc string, n int, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(t, version=None):
    return sorted((tuple(r) for r in t.read(version).collect()), key=str)


def test_shorter_version_leaves_no_tail(spark, tmp_path):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 8)
    assert content(t) == []
    t.upsert(frame(spark, [("a", i, f"old{i}") for i in range(5)] + [("b", 0, "b")]))
    t.upsert(frame(spark, [("a", 0, "new")]))
    assert content(t) == [("a", 0, "new"), ("b", 0, "b")]
    assert len(content(t, 1)) == 6  # the version before is still there


def test_only_buckets_of_the_keys_are_rewritten(spark, tmp_path):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 16)
    t.upsert(frame(spark, [(f"d{i}", 0, "x") for i in range(200)]))
    before = t.manifest()["entries"]
    c = t.upsert(frame(spark, [("d7", 0, "y"), ("d7", 1, "z")]))
    after = t.manifest()["entries"]
    assert len(c["rewritten"]) == 1 and c["added"] == c["rewritten"]
    assert {b for b in before if before[b] != after[b]} == set(c["rewritten"])
    c = t.upsert(frame(spark, [("new", 0, "y")]))  # no old row: a further folder, nothing rewritten
    assert c["rewritten"] == [] and len(c["added"]) == 1
    assert t.lookup(spark.createDataFrame([("d7",), ("new",), ("none",)], "doc string")).count() == 3


def test_deletes_hide_older_rows_until_compaction(spark, tmp_path):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 4)
    t.upsert(frame(spark, [("a", 0, "1"), ("b", 0, "2"), (None, 0, "3")]))
    data = {p for e in t.manifest()["entries"].values() for p in e["data"]}
    t.delete(spark.createDataFrame([("a",), (None,), ("never",)], "doc string"))
    assert content(t) == [("b", 0, "2")]
    assert {p for e in t.manifest()["entries"].values() for p in e["data"]} == data
    t.append(frame(spark, [("a", 0, "again")]))  # written after the delete
    assert content(t) == [("a", 0, "again"), ("b", 0, "2")]
    t.compact()
    assert content(t) == [("a", 0, "again"), ("b", 0, "2")]
    assert not any(e["deletes"] for e in t.manifest()["entries"].values())
    gone = t.vacuum()
    assert gone and content(t) == [("a", 0, "again"), ("b", 0, "2")] and t._versions() == [t.version]


def test_failed_commit_leaves_the_old_version(spark, tmp_path, monkeypatch):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 4)
    t.upsert(frame(spark, [("a", 0, "1"), ("a", 1, "2")]))
    bad = frame(spark, [("a", 0, "x")]).withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        t.upsert(bad)
    assert content(t) == [("a", 0, "1"), ("a", 1, "2")] and t.version == 1
    monkeypatch.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone before the manifest")))
    with pytest.raises(OSError):
        t.upsert(frame(spark, [("a", 0, "y")]))
    monkeypatch.undo()
    assert content(t) == [("a", 0, "1"), ("a", 1, "2")]
    assert len(t.vacuum()) >= 2  # the folders of both failures
    assert content(t) == [("a", 0, "1"), ("a", 1, "2")]


def test_two_writers_cannot_make_the_same_version(spark, tmp_path):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 4)
    old = t.manifest()
    t.upsert(frame(spark, [("a", 0, "1")]))
    with pytest.raises(Conflict):
        t._commit(old, {}, {"kind": "late"}, None)
    assert content(t) == [("a", 0, "1")]
    with pytest.raises(Conflict):
        VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 4)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 4)
    t.append(frame(spark, [("a", 0, "1")]), writer=("w", 0))
    assert t.append(frame(spark, [("a", 0, "1")]), writer=("w", 0))["kind"] == "skipped"
    t.append(frame(spark, [("a", 0, "1")]), writer=("other", 0))
    assert content(t) == [("a", 0, "1")] * 2


def test_stored_higher_version_stays(spark, tmp_path):
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 4)
    t.upsert(frame(spark, [("a", 5, "five"), ("b", 1, "one")]))
    t.upsert(frame(spark, [("a", 4, "four"), ("b", 2, "two"), ("c", 0, "zero")]), version_col="n")
    assert content(t) == [("a", 5, "five"), ("b", 2, "two"), ("c", 0, "zero")]


def test_random_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "MAX_FOLDERS", 3)
    r = random.Random(4)
    t = VersionedTable.create(spark, str(tmp_path / "t"), SCHEMA, "doc", 3)
    docs: dict = {}
    for step in range(12):
        names = r.sample([None, *"abcdefgh"], 3)
        if step % 4 == 3:
            t.delete(spark.createDataFrame([(n,) for n in names], "doc string"))
            for n in names:
                docs.pop(n, None)
        else:
            new = {n: [(n, i, f"{step}") for i in range(r.randint(1, 3))] for n in names}
            t.upsert(frame(spark, [x for rows in new.values() for x in rows]))
            docs |= new
        if step == 8:
            t.compact()
            t.vacuum(keep=2)
        assert content(t) == sorted((x for rows in docs.values() for x in rows), key=str)


def test_bad_tables(spark, tmp_path):
    with pytest.raises(ValueError):
        VersionedTable.create(spark, str(tmp_path / "x"), SCHEMA, "nothere")
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, str(tmp_path / "y"))
    t = VersionedTable.open(spark, str(tmp_path / "z"), SCHEMA, "doc")
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([("a", 1)], "doc string, other int"))
    t.append(spark.createDataFrame([("a",)], "doc string"))
    assert content(VersionedTable.open(spark, str(tmp_path / "z"), SCHEMA, "doc")) == [("a", None, None)]
