"""Composite flows users call by name, built only from library operators.

Each flow is a function of DataFrames; Spark plans the whole chain as one
query (or a few, where a step needs a bounded driver-side value such as a
query block or a vocabulary).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import token_estimate
from tessera.operators import aggregates as A
from tessera.operators import filters as FL
from tessera.operators import joins as J
from tessera.operators.lexindex import LexicalIndex
from tessera.operators.vecindex import VectorIndex
from tessera.operators import retrieval as RT
from tessera.operators import routing as R
from tessera.operators import shaping as P
from tessera.operators import text as TX
from tessera.operators import vectors as V
from tessera.sources import files as S

# --------------------------------------------------------------- X1 ingest


#: chunks of ingested documents; a stored table replaces them by ``document_id``
CHUNK_SCHEMA = ("id string, document_id string, chunk_no int, text string, embedding array<float>, "
                "bucket string, collection string, metadata map<string,string>")


def rag_ingest(docs: DataFrame, collection: str, size: int = 512, overlap: int = 50, dims: int = 256,
               id_col: str = "doc_id", text: str = "text", html: bool = False,
               metadata: dict[str, Any] | None = None) -> DataFrame:
    """load -> (parse) -> chunk -> embed -> chunk table ready to upsert."""
    src = docs
    if html:
        src = TX.parse_html(docs, text, id_col)
    ch = TX.chunk_fixed(src, text, size, overlap, id_col)
    ch = ch.withColumn("id", F.concat_ws(":", F.col(id_col).cast("string"), F.col("chunk_no").cast("string")))
    emb = V.embed(ch, "chunk", dims, id_col="id")
    out = emb.select("id", F.col(id_col).cast("string").alias("document_id"), "chunk_no",
                     F.col("chunk").alias("text"), "embedding")
    return S.ingest_upload(out, bucket="default", collection=collection, metadata=metadata)


# ------------------------------------------------------------ X2 / X3 / X4


def rag_context(queries: DataFrame, corpus: DataFrame, k: int = 5, template: str = "{{context}}\n\nQ: {{query}}",
                depth: int = 20, qid_col: str = "query_id", qtext: str = "text", index: LexicalIndex | None = None,
                vectors: VectorIndex | None = None) -> DataFrame:
    """search (hybrid) -> rerank -> prompt template; everything before the LLM.
    With a stored ``index`` and ``vectors`` only the texts of the hits are read from the corpus."""
    hits = RT.hybrid_search(queries, corpus, k=depth, depth=depth, qid_col=qid_col, qtext=qtext, index=index, vectors=vectors)
    q = queries.select(F.col(qid_col).alias("query_id"), F.col(qtext).alias("query_text"))
    h = hits.join(corpus.select(F.col("doc_id").alias("id"), "text"), "id").join(q, "query_id")
    rr = RT.rerank_score(h, k=k)
    # at most k hits per query: the list per query is bounded
    ctx = rr.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("rerank").alias("r"), F.col("text").alias("text"), F.col("rerank_score").alias("score")))).alias("_c"))
    ctx = ctx.select("query_id", F.transform("_c", lambda s: F.struct(s["text"].alias("text"), s["score"].alias("score"))).alias("context"))
    base = q.join(ctx, "query_id", "left").withColumnRenamed("query_text", "query")
    return P.render_template(base, template).select("query_id", "prompt")


#: context modes that run here; the others need a language model and fall back to ``auto``
CONTEXT_MODES = ("auto", "naive", "rerank")


def bucket_context(queries: DataFrame, corpus: DataFrame, grants: DataFrame, roles: Sequence[str],
                   budget: int = 2000, k: int = 10, filters: dict | None = None, sessions: DataFrame | None = None, n_turns: int = 0,
                   qid_col: str = "query_id", qtext: str = "text", mode: str = "auto") -> DataFrame:
    """The flagship: restrict -> metadata filter -> search -> session turns ->
    pack into a token budget -> one row per query.

    ``mode``: ``naive`` searches by words alone, ``auto`` by words and vectors,
    ``rerank`` re-scores the hits of ``auto``; any other falls back to ``auto``.
    The newest turns come first in the text and are paid from the budget before
    the chunks. Columns: ``context``, ``tokens_used`` (of all of it), ``chunks``
    (id, text, score, metadata of every retrieved chunk, in citation order),
    ``session_turns`` (role, content), ``n_included``, ``n_truncated``,
    ``n_skipped`` and ``mode_used``.
    """
    used = mode if mode in CONTEXT_MODES else "auto"
    c = RT.restrict(corpus, grants, roles=roles)
    if filters:
        c = FL.metadata_filter(c, filters)
    q = queries.select(F.col(qid_col).alias("query_id"), F.col(qtext).alias("query_text"))
    if used == "naive":
        hits = RT.bm25_search(queries, c, k, qid_col, qtext)
    else:
        hits = RT.hybrid_search(queries, c, k=k, depth=2 * k if used == "rerank" else None, qid_col=qid_col, qtext=qtext)
    h = hits.join(c.select(F.col("doc_id").alias("id"), "text", "metadata"), "id")
    if used == "rerank":
        h = RT.rerank_score(h.join(q, "query_id"), k=k).drop("rank", "score").withColumnsRenamed({"rerank": "rank", "rerank_score": "score"})
    # one use of the hits: text, counts and chunk list (k hits and n turns a query at most) come from one aggregate
    h = h.withColumn("chunk", F.struct(F.col("id").cast("string").alias("id"), "text", "score", "metadata")).select("query_id", "id", "text", "metadata", "rank", "chunk")
    packing = P.format_citation(h, "[{source}:{id}]", out="citation").withColumn("text", F.concat(F.col("citation"), F.lit(" "), F.col("text")))
    out = q.select("query_id")
    turns = None
    if sessions is not None and n_turns > 0:
        own = sessions.join(q.select(F.col("query_id").alias("conv_id")), "conv_id", "left_semi")
        turns = J.recent_turns(own, n_turns, budget).withColumnRenamed("conv_id", "query_id")
        packing = packing.join(turns.select("query_id", "spent"), "query_id", "left")
        out = out.join(turns.withColumnsRenamed({"turns": "session_turns"}), "query_id", "left")
    else:
        out = out.withColumns({"session_turns": F.array().cast("array<struct<role:string,content:string>>"), "turns_text": F.lit(None).cast("string"), "spent": F.lit(0).cast("long")})
    out = out.join(RT.pack_context(packing, budget, spent_col=None if turns is None else "spent", chunk_col="chunk"), "query_id", "left")
    zero = {n: F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_included", "n_truncated", "n_skipped")}
    text = F.concat_ws("\n\n", "turns_text", F.when(F.col("context") != "", F.col("context")))
    return out.select("query_id", text.alias("context"), (F.coalesce("tokens_used", F.lit(0)) + F.coalesce("spent", F.lit(0))).cast("long").alias("tokens_used"),
                      F.coalesce("chunks", F.array().cast(out.schema["chunks"].dataType)).alias("chunks"),
                      F.coalesce("session_turns", F.array().cast(out.schema["session_turns"].dataType)).alias("session_turns"), *zero.values(), F.lit(used).alias("mode_used"))


def multi_source_context(queries: DataFrame, corpora: dict[str, DataFrame], k: int = 5,
                         template: str = "{{context}}\n\nQ: {{query}}", qid_col: str = "query_id",
                         qtext: str = "text") -> DataFrame:
    """search several stores -> merge -> rerank -> template."""
    hits = RT.search_many(queries, corpora, k=k * 2, qid_col=qid_col, qtext=qtext)
    texts = None
    for name, c in corpora.items():
        part = c.select(F.col("doc_id").alias("id"), "text").withColumn("collection", F.lit(name))
        texts = part if texts is None else texts.unionByName(part)
    q = queries.select(F.col(qid_col).alias("query_id"), F.col(qtext).alias("query_text"))
    h = hits.join(texts, ["collection", "id"]).join(q, "query_id")
    rr = RT.rerank_score(h, k=k)
    ctx = rr.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("rerank").alias("r"), F.col("text").alias("text"), F.col("rerank_score").alias("score")))).alias("_c"))
    ctx = ctx.select("query_id", F.transform("_c", lambda s: F.struct(s["text"].alias("text"), s["score"].alias("score"))).alias("context"))
    base = q.join(ctx, "query_id", "left").withColumnRenamed("query_text", "query")
    return P.render_template(base, template).select("query_id", "prompt")


# ------------------------------------------------------------------ X5


def invoice_table(df: DataFrame, col: str, schema: dict, fields: Sequence[str]) -> DataFrame:
    """Structured replies -> one row per line item -> selected columns."""
    parsed = P.apply_json_schema(df, col, schema, out="v").select("v.*")
    return P.select_paths(parsed, list(fields)).select(
        *[F.col(f.replace("[]", "").replace(".", "_")) for f in fields]).transform(_explode_lists)


def _explode_lists(df: DataFrame) -> DataFrame:
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    if not arrays:
        return df
    z = F.arrays_zip(*[F.col(a) for a in arrays])
    scal = [c for c in df.columns if c not in arrays]
    out = df.select(*scal, F.explode(z).alias("_z"))
    return out.select(*scal, *[F.col(f"_z.{a}").alias(a.replace("line_items_", "line_")) for a in arrays])


# ------------------------------------------------------------ X6 / X7 / X8


def scheduled_sync(df: DataFrame, fields: Sequence[tuple[str, str, Any]], conditions: Sequence,
                   group_by: str | None, aggs: Sequence[tuple[str, str]]) -> DataFrame:
    """set -> filter -> summarize (the scheduled batch template)."""
    s = P.set_fields(df, fields)
    f = FL.filter_rows(s, conditions)
    return A.summarize(f, group_by, aggs)


def branch_flow(df: DataFrame, field: str, op: str, value: Any,
                on_true: Callable[[DataFrame], DataFrame], on_false: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """condition -> a function per branch -> append (with the branch label)."""
    lab = R.split_condition(df, field, op, value)
    t = on_true(lab.filter(F.col("branch") == "true"))
    f = on_false(lab.filter(F.col("branch") == "false"))
    return J.merge_append(t, f)


def switch_flow(df: DataFrame, rules: Sequence[dict], fns: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """switch -> a function per output -> append. Outputs without a function pass through."""
    lab = R.switch_rules(df, rules)
    outputs = [r["output"] for r in rules] + ["default"]
    parts = []
    for o in dict.fromkeys(outputs):
        part = lab.filter(F.col("output") == o)
        parts.append(fns.get(o, lambda x: x)(part))
    return J.merge_append(*parts).drop("source_no")


# ------------------------------------------------------------------ V15

# fixed values (ours): polarity anchors
FAVORABLE_TEXT = "supports agrees confirms favorable approves consistent evidence for"
COUNTER_TEXT = "contradicts disagrees rejects unfavorable disputes inconsistent evidence against"
NEUTRAL_MARGIN = 0.02

def decision_review(issues: DataFrame, corpus: DataFrame, k: int = 5, issue_col: str = "issue_id",
                    text: str = "text", dims: int = 256, favorable_hits: int = 3, counter_hits: int = 3,
                    neutral_hits: int = 3) -> DataFrame:
    """Per sub-issue (the sentences of an issue): hybrid top-k evidence, a
    polarity per hit (nearer to the favorable or the counter anchor, neutral
    within a margin; ours), counts per polarity and the top hits per polarity
    up to the number asked for each. Only documents that are hits are embedded."""
    subs = TX.sentences(issues, text, issue_col).select(
        F.concat_ws(":", F.col(issue_col).cast("string"), F.col("sent_no").cast("string")).alias("query_id"),
        F.col(issue_col), F.col("sentence").alias("text"))
    hits = RT.hybrid_search(subs, corpus, k=k)
    anchors = corpus.sparkSession.createDataFrame([("favorable", FAVORABLE_TEXT), ("counter", COUNTER_TEXT)], "label string, text string")
    av = V.embed(anchors, "text", dims, id_col="label").select("label", F.col("embedding").alias("centroid"))
    found = corpus.select(F.col("doc_id").alias("id"), "text").join(hits.select("id").distinct(), "id", "left_semi")
    docs = V.embed(found, "text", dims, id_col="id")
    h = hits.join(docs.select("id", "embedding"), "id")
    cl = V.classify(h, av, "label")
    fav = F.col("scores")["favorable"]
    con = F.col("scores")["counter"]
    pol = F.when(F.abs(fav - con) < NEUTRAL_MARGIN, "neutral").when(fav > con, "favorable").otherwise("counter")
    p = cl.withColumn("polarity", pol)
    w = Window.partitionBy("query_id", "polarity").orderBy("rank")
    p = p.withColumn("_pr", F.row_number().over(w))
    shown = F.when(F.col("polarity") == "favorable", favorable_hits).when(F.col("polarity") == "counter", counter_hits).otherwise(neutral_hits)
    g = p.groupBy("query_id").agg(
        F.sum(F.when(F.col("polarity") == "favorable", 1).otherwise(0)).alias("n_favorable"),
        F.sum(F.when(F.col("polarity") == "counter", 1).otherwise(0)).alias("n_counter"),
        F.sum(F.when(F.col("polarity") == "neutral", 1).otherwise(0)).alias("n_neutral"),
        F.array_sort(F.collect_list(F.when(F.col("_pr") <= shown, F.struct("polarity", "rank", "id")))).alias("shown"))
    return subs.select("query_id", issue_col).join(g, "query_id", "left")


# ------------------------------------------------------------------- R6


def route_by_similarity(df: DataFrame, routes: Sequence[dict], text: str = "text", dims: int = 256,
                        default: str = "default", min_score: float = 0.0) -> DataFrame:
    """Route by meaning (ours; the reference asks an LLM): the hashed-word
    embedding of the text against each route's description; best cosine
    wins, ``default`` when no route scores above ``min_score``."""
    spark = df.sparkSession
    rv = V.embed(spark.createDataFrame([(r["name"], r["description"]) for r in routes], "label string, text string"),
                 "text", dims, id_col="label").select("label", F.col("embedding").alias("centroid"))
    e = V.embed(df, text, dims, out="_e").drop("model", "dimensions")
    c = V.classify(e, rv, "label", vec_col="_e")
    return c.withColumn("route", F.when(F.col("score") > min_score, F.col("predicted")).otherwise(F.lit(default))) \
        .withColumn("confidence", F.round("score", 6)).drop("_e", "predicted", "score", "scores")
