"""Migration runs, many labels, wide vectors, tool lists of a hot key."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import routing as R
from tessera.operators import vectors as V
from tessera.operators.aggregates import quote
from tessera.operators.migration import Migration
from tessera.sources.versioned import VersionedTable


def test_migration_goes_on_where_it_stopped(spark, tmp_path):
    r = np.random.default_rng(3)
    q, _ = np.linalg.qr(r.normal(size=(4, 4)))
    x = r.normal(size=(200, 4))
    src = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    truth = spark.createDataFrame([(i, (v @ q).tolist()) for i, v in enumerate(x)], "id long, target array<double>")
    target = VersionedTable.create(spark, str(tmp_path / "t"), "id long, embedding array<double>", "id", 4)
    new = lambda: Migration(src, q, target, "j", ranges=5, truth=truth)
    assert new().status().first().asDict() == {"job": "j", "state": "queued", "progress": 0.0, "n_total": 200, "n_projected": 0, "sample_retention": None}
    assert new().run(stop_after=3) == [0, 1, 2]
    half = new().status().first()
    assert half["state"] == "running" and 0 < half["n_projected"] < 200 and half["n_projected"] == target.read().count()
    version = target.version
    assert new().run() == [3, 4] and target.version == version + 2  # none is repeated
    assert new().run() == []
    end = new().status().first()
    assert (end["state"], end["progress"], end["n_projected"]) == ("done", 1.0, 200) and end["sample_retention"] > 0.999
    assert target.read().count() == 200


def test_any_number_of_labels(spark, monkeypatch):
    r = np.random.default_rng(4)
    labels = [(f"l{i:04}", r.normal(size=6).tolist()) for i in range(1500)]
    rows = [(i, r.normal(size=6).tolist()) for i in range(60)] + [(60, [0.0] * 6)]
    lv, df = spark.createDataFrame(labels, "label string, centroid array<double>"), spark.createDataFrame(rows, "id long, embedding array<double>")
    unit = lambda a: a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    cos = np.round(unit(np.array([v for _, v in rows])) @ unit(np.array([v for _, v in labels])).T, 12)
    want = {i: max(zip(c, [n for n, _ in labels]))[1] for (i, _), c in zip(rows, cos)}
    one = V.classify(df, lv)
    assert {x["id"]: x["predicted"] for x in one.collect()} == want
    assert all(abs(sum(x["scores"].values()) - 1) < 1e-9 and len(x["scores"]) == 1500 for x in one.limit(3).collect())
    monkeypatch.setattr(V, "LABEL_CELLS", 6 * 200)
    many = V.classify(df, lv).collect()
    assert {x["id"]: x["predicted"] for x in many} == want and all(x["scores"] is None for x in many)
    with pytest.raises(ValueError):
        V.classify(df, lv.limit(0))


def test_wide_vectors_are_quantized(spark):
    wide = 70_000
    rows = [(i, [float((i * j) % 7) for j in range(wide)]) for i in range(3)]
    q, _ = V.quantize_sq8(spark.createDataFrame(rows, "id long, embedding array<double>"))
    err = q.select(F.size("codes").alias("n"), F.array_max(F.zip_with("restored", "embedding", lambda a, b: F.abs(a - b))).alias("e")).collect()
    assert all(x["n"] == wide and x["e"] <= 6 / 255 / 2 + 1e-9 for x in err)


def test_tools_of_a_hot_key(spark):
    rules = [{"name": "a", "allowed_tools": ["t2", "t1"]}, {"name": "b", "allowed_tools": ["t3"]}, {"name": "c"}]
    df = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3)).alias("key"),
                                  F.when(F.col("id") % 2 == 0, "a").when(F.col("id") % 7 == 0, "b").otherwise("c").alias("skill"))
    df = df.unionByName(spark.createDataFrame([("none", "c"), ("null", None), ("other", "zz")], "key string, skill string"))
    got = {x["key"]: x["allowed_tools"] for x in R.allowed_tools(df, rules, "key").collect()}
    assert got == {"hot": ["t1", "t2", "t3"], "k0": ["t1", "t2", "t3"], "k1": ["t1", "t2", "t3"], "k2": ["t1", "t2", "t3"], "none": None, "null": None, "other": None}


@pytest.mark.parametrize("n, retain, cents", [(0, True, 0), (100_000, True, 0), (100_001, True, 1), (1_100_000, True, 10), (1_100_000, False, 50), (350_000, False, 13)])
def test_quote(spark, n, retain, cents):
    r = quote(spark.range(n).select(F.array(F.lit(1.0), F.lit(2.0)).alias("embedding")), retain).first()
    assert (r["n_total_vectors"], r["quote_cents"], r["quote_usd"], r["free_tier"], r["requires_payment"]) == (n, cents, cents / 100, n <= 100_000, cents > 0)
    assert r["rate_per_million_cents"] == (10 if retain else 50) and r["src_dim"] == (2 if n else 0)
