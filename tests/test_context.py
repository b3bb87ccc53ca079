"""The context of a query: every field of the answer, in each mode."""

from tessera.plans import flows as X

DOCS = [(i, f"alpha beta word{i} " + "filler " * (i * 3), "pub" if i % 2 else "sec", {"source": f"src{i}"}) for i in range(12)] + [(50, "alpha " * 9, "sec", {"source": "src50"})]


def run(spark, **kw):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, collection string, metadata map<string,string>")
    grants = spark.createDataFrame([("pub", "role", "r", "search")], "collection_id string, subject_type string, subject_id string, permission string")
    q = spark.createDataFrame([(1, "alpha word3"), (2, "nothing known"), (3, "beta")], "query_id long, text string")
    turns = spark.createDataFrame([(1, 0, "user", "old"), (1, 1, "assistant", "mid"), (1, 2, "user", "new"), (3, 0, "user", "x" * 5000)], "conv_id long, turn long, role string, text string")
    return {r["query_id"]: r for r in X.bucket_context(q, docs, grants, ["r"], sessions=turns, n_turns=2, k=3, **kw).collect()}


def test_fields(spark):
    got = run(spark, mode="naive")
    r = got[1]
    assert [(t["role"], t["content"]) for t in r["session_turns"]] == [("assistant", "mid"), ("user", "new")]
    assert r["context"].startswith("assistant: mid\nuser: new\n\n[1] [src3:3] alpha beta word3")
    assert r["chunks"][0]["id"] == "3" and r["chunks"][0]["metadata"] == {"source": "src3"} and r["chunks"][0]["score"] > r["chunks"][1]["score"]
    assert len(r["chunks"]) == 3 == r["n_included"] and r["tokens_used"] >= len(r["context"]) / 4
    # the best hit for alpha lies in a collection that is not granted
    assert all(int(c["id"]) % 2 == 1 for x in got.values() for c in x["chunks"])
    assert (got[2]["chunks"], got[2]["context"], got[2]["tokens_used"]) == ([], "", 0)
    assert got[3]["session_turns"] == [] or len(got[3]["session_turns"][0]["content"]) == 5000


def test_turns_are_paid_first(spark):
    r = run(spark, mode="naive", budget=10)[1]
    assert r["context"].startswith("assistant: mid\nuser: new") and r["tokens_used"] <= 10 and r["n_skipped"] + r["n_truncated"] == 3
    r = run(spark, mode="naive", budget=3)[1]  # only the newest turn fits
    assert [t["content"] for t in r["session_turns"]] == ["new"] and r["n_included"] == 0


def test_modes(spark):
    used = {m: {x["mode_used"] for x in run(spark, mode=m).values()} for m in ("auto", "naive", "rerank", "hyde")}
    assert used == {"auto": {"auto"}, "naive": {"naive"}, "rerank": {"rerank"}, "hyde": {"auto"}}
    best = run(spark, mode="rerank")[1]["chunks"]
    assert best[0]["id"] == "3" and len(best) == 3
