"""User code per group: batches cut into groups by the task, with the frames that applyInPandas gives."""

import datetime
import random

import pandas as pd
import pytest

from tessera.operators import registry as U

SCHEMA = "k long, s string, n int, b boolean, d date, x double"


def _rows():
    r = random.Random(4)
    pick = lambda *v: r.choice([None, *v])
    return [(pick(1, 2, 2 ** 60, 2 ** 60 + 1, i // 7), pick("", "a", "b"), pick(5, -7), pick(True, False),
             pick(datetime.date(2024, 1, 1), datetime.date(1890, 5, 6)), pick(0.0, -0.0, 1.5, float("nan"))) for i in range(600)]


def describe(pdf):
    """What user code can see of a group, but for the order of its rows."""
    kept = sorted(map(str, pdf.itertuples(index=False, name=None)))
    pdf.loc[0, "n"] = 9  # user code may change its frame
    return pd.DataFrame({"seen": [str((list(pdf.columns), [str(t) for t in pdf.drop(columns="n").dtypes], list(pdf.index)[:3], len(pdf), kept))]})


@pytest.mark.parametrize(("keys", "batch"), [(["k"], 7), (["s", "b"], 7), (["d"], 10_000), (["n", "k", "s"], 10_000)])
def test_same_frames_as_apply_in_pandas(spark, keys, batch):
    df = spark.createDataFrame(_rows(), SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = U.code_groups(df, keys, describe, "seen string")
        assert "FlatMapGroupsInPandas" not in got._jdf.queryExecution().executedPlan().toString()
        got = sorted(r["seen"] for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(r["seen"] for r in df.groupBy(*keys).applyInPandas(describe, "seen string").collect())


def test_results_keep_their_types(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "k long, v long")

    def fn(pdf):
        k = int(pdf["k"].iloc[0])
        if k % 3 == 0:
            return pd.DataFrame()
        return pd.DataFrame({"big": [2 ** 60 + k if k % 3 == 1 else None, 1], "k": k})
    want = sorted(((2 ** 60 + k if k % 3 == 1 else None, k) for k in range(300) if k % 3), key=str) + [(1, k) for k in range(300) if k % 3]
    got = [tuple(r) for r in U.code_groups(df, ["k"], fn, "big long, k long").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    with pytest.raises(Exception, match="pandas frame"):
        U.code_groups(df, ["k"], lambda pdf: 1, "k long").collect()


def test_other_types_and_code_with_the_key(spark):
    df = spark.createDataFrame([(1, [1, 2], 0.0), (1, [3], -0.0), (2, None, 1.0)], "k long, v array<long>, f double")
    n = lambda pdf: pd.DataFrame({"n": [len(pdf)]})
    assert sorted(r["n"] for r in U.code_groups(df, ["k"], n, "n long").collect()) == [1, 2]
    assert sorted(r["n"] for r in U.code_groups(df.drop("v"), ["f"], n, "n long").collect()) == [1, 2]
    keyed = lambda key, pdf: pd.DataFrame({"n": [key[0] * 10 + len(pdf)]})
    assert sorted(r["n"] for r in U.code_groups(df.drop("v"), ["k"], keyed, "n long").collect()) == [12, 21]
    assert U.code_groups(df.drop("v").limit(0), ["k"], n, "n long").count() == 0
