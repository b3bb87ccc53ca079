"""Pipeline stages against brute force, each on its own input."""

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_llm_operators import brute_classes, folded, plain


def test_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF001).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
        if name != "mixing":
            assert tables[-1].columns == columns
    raw, calm, lines, single, clean, mixed = tables
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF001}/labels.parquet").where("toxic = 0").collect()}
    texts = {r["doc_id"]: r["text"] for r in raw.collect()}
    assert toxic <= {r["doc_id"] for r in calm.collect()}  # texts labelled clean stay
    seen = [tuple(plain(x)) for r in lines.orderBy("doc_id").collect() for x in r["text"].split("\n") if len(plain(x)) >= 5]
    assert len(seen) == len(set(seen))
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect() if r["text"] != texts[r["doc_id"]])
    rows = [(r["doc_id"], r["text"], None) for r in lines.collect()]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, c, _ in brute_classes(rows)})
    windows = set()
    for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect():
        w = folded(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, min(1, len(w))))}
    short = {len(w) for w in windows}
    hit = lambda t: any(tuple(w[i:i + k]) in windows for w in [folded(t)] for k in short for i in range(len(w) - k + 1))
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect() if not hit(r["text"])}
    sums = mixed.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert mixed.count() == clean.count() and all(r["sum(taken)"] <= r["max(target)"] + 1 for r in sums)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF001).collect())) == sorted(map(tuple, mixed.collect()))
