"""Retrieval: lexical (BM25), vector and hybrid top-k, multi-collection
search, permission filtering, re-ranking and token-budget context packing.

Top-k never emits all (query, document) pairs: every corpus task scores its
batch against a bounded, broadcast query block and keeps ``k`` rows per
query; a window group limit merges the task results. Term statistics are
grouped aggregates over the query vocabulary only.

Scoring constants are ours (the reference names the methods, not the math):
BM25 ``k1 = 1.2``, ``b = 0.75``, ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``;
reciprocal rank fusion constant 60; tokens of a text = ``ceil(chars / 4)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.operators.vectors import SCORE_CELLS, Best, _hit_schema, _keep_best, block_topk, cosine, embed, query_blocks, word_tokens

if TYPE_CHECKING:
    from tessera.operators.lexindex import LexicalIndex
    from tessera.operators.vecindex import VectorIndex

BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
QUERY_BLOCK = 2048           # queries scored per corpus pass


# fixed values (ours): the word tokenizer shared by every lexical operator:
# lower case, split on runs of characters that are neither letters nor digits
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def _py_tokens(text: str | None) -> list[str]:
    import regex

    return [t for t in regex.split(TOKEN_SPLIT, (text or "").lower()) if t]


def _doc_terms(corpus: DataFrame, id_col: str, text: str, vocab: dict[str, int]) -> DataFrame:
    """One row per document: its length, and the query terms it holds (their
    numbers) with their counts, the only part of the text that scoring needs.
    Tokenizing runs once per document in Arrow batches; the result is small and
    stored for the statistics and the scoring pass."""
    from tessera.session import arrow_slices, cut_lineage, ensure_parallel

    bvocab = corpus.sparkSession.sparkContext.broadcast(vocab)
    id_type = corpus.schema[id_col].dataType
    schema = T.StructType([T.StructField("_id", id_type), T.StructField("_dl", T.LongType()),
                           T.StructField("_terms", T.ArrayType(T.IntegerType())),
                           T.StructField("_tfs", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        vs, target = bvocab.value, to_arrow_schema(schema)
        for b in arrow_slices(batches):
            dls, terms, tfs = [], [], []
            for t in b.column(1).to_pylist():
                toks = _py_tokens(t)
                c = Counter(vs[x] for x in toks if x in vs)
                dls.append(len(toks))
                terms.append(list(c))
                tfs.append([float(v) for v in c.values()])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(target[0].type), *[pa.array(x, f.type) for x, f in zip((dls, terms, tfs), list(target)[1:])]], schema=target)

    return cut_lineage(ensure_parallel(corpus.select(id_col, text)).mapInArrow(run, schema))


def _bm25_stats(per_doc: DataFrame) -> tuple[dict[int, int], int, int]:
    """Document frequency per query term, document count and total length
    (one job over the stored per-document rows)."""
    docs = per_doc.select(F.lit(None).cast("int").alias("term"), F.col("_dl").alias("dl"))
    terms = per_doc.select(F.explode("_terms").alias("term"), F.lit(0).cast("long").alias("dl"))
    st = docs.unionByName(terms).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("dl"))
    dfc, n_docs, total_dl = {}, 0, 0
    for r in st.collect():  # a row per term of one query block, and one
        if r["term"] is None:
            n_docs, total_dl = r["n"], r["dl"] or 0
        else:
            dfc[r["term"]] = r["n"]
    return dfc, n_docs, total_dl


def _bm25_block(rows: list, corpus: DataFrame, id_col: str, text: str, k: int, schema: T.StructType, k1: float, b: float) -> DataFrame | None:
    """Score one block of queries. Each term has the list of the queries that
    ask for it; a document adds its term weights along these lists only."""
    vocab = {t: i for i, t in enumerate(sorted({t for r in rows for t in (r["terms"] or [])}))}
    if not vocab:
        return None
    per_doc = _doc_terms(corpus, id_col, text, vocab)
    dfc, n_docs, total_dl = _bm25_stats(per_doc)
    avgdl = total_dl / n_docs if n_docs else 0.0
    idf = np.array([math.log(1.0 + (n_docs - dfc.get(i, 0) + 0.5) / (dfc.get(i, 0) + 0.5)) for i in range(len(vocab))])
    pairs = np.array([(vocab[t], j) for j, r in enumerate(rows) for t in (r["terms"] or [])], dtype=np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    first = np.searchsorted(pairs[:, 0], np.arange(len(vocab) + 1))
    payload = corpus.sparkSession.sparkContext.broadcast(([r["q"] for r in rows], pairs[:, 1], first, idf))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, asking, first, idf = payload.value
        n_asking = np.diff(first)
        # scores are rounded to 9 places, so ties are exact and broken by id; a score of 0 is no hit
        best = Best(len(qids), k, least=1e-9)
        for pdf in batches:
            held = pdf["_terms"].map(len).to_numpy(np.int64)
            if not held.sum():
                continue
            term = np.concatenate([np.asarray(x, dtype=np.int64) for x in pdf["_terms"]])
            tf = np.concatenate([np.asarray(x, dtype=np.float64) for x in pdf["_tfs"]])
            doc = np.repeat(np.arange(len(pdf)), held)
            weight = idf[term] * tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * pdf["_dl"].to_numpy(np.float64)[doc] / avgdl))
            # slices of documents by the scores they hold and the additions they take
            work = np.cumsum(len(qids) + np.bincount(doc, n_asking[term], len(pdf)))
            cuts = np.flatnonzero(np.diff((work // SCORE_CELLS).astype(np.int64))) + 1
            for lo, hi in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(pdf)]))):
                x, y = np.searchsorted(doc, (lo, hi))
                n = n_asking[term[x:y]]
                if not n.sum():
                    continue
                at = np.repeat(first[term[x:y]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                cell = np.repeat(doc[x:y] - lo, n) * len(qids) + asking[at]
                s = np.bincount(cell, np.repeat(weight[x:y], n), (hi - lo) * len(qids)).reshape(hi - lo, len(qids))
                best.add(pdf["_id"].to_numpy()[lo:hi], np.round(s, 9))
        yield from best.rows(qids)

    return per_doc.mapInPandas(run, schema)


def bm25_search(queries: DataFrame, corpus: DataFrame, k: int = 10, qid_col: str = "query_id",
                qtext: str = "text", id_col: str = "doc_id", text: str = "text",
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Lexical top-k by BM25 (ours: constants above). Output
    ``(query_id, id, score, rank)``; documents sharing no term are no hits.

    Plan: the query set is read in blocks of about ``QUERY_BLOCK`` queries, one
    at a time; for each, the corpus is tokenized once into per-document counts
    of the block's terms (stored), which give the term statistics (one small
    ``groupBy``) and feed one scoring pass. No (document, term) pairs are
    shuffled and no (query, document) pairs are emitted: every task keeps ``k``
    rows per query over all of its documents, a window group limit keeps the
    global k. More queries mean more passes, never a larger broadcast.
    """
    schema = _hit_schema(corpus, id_col, queries, qid_col)
    qt = queries.select(F.col(qid_col).alias("q"), F.array_distinct(word_tokens(F.col(qtext))).alias("terms"))
    parts = [_bm25_block(rows, corpus, id_col, text, k, schema, k1, b) for rows in query_blocks(qt, QUERY_BLOCK)]
    return _keep_best([p for p in parts if p is not None], k, corpus.sparkSession.createDataFrame([], schema))


def dense_search(queries: DataFrame, corpus: DataFrame, k: int = 10, qid_col: str = "query_id",
                 qtext: str = "text", id_col: str = "doc_id", text: str = "text", dims: int = 256) -> DataFrame:
    """Vector top-k on hashed-word embeddings of query and document text."""
    q = embed(queries.select(F.col(qid_col).alias("query_id"), F.col(qtext).alias("text")), "text", dims,
              id_col="query_id")
    from tessera.session import ensure_parallel

    c = embed(ensure_parallel(corpus.select(F.col(id_col).alias("id"), F.col(text).alias("text"))), "text", dims,
              id_col="id")
    return block_topk(c.select("id", "embedding"), q.select("query_id", "embedding"), k)


def rrf(*ranked: DataFrame, k: int = 10, c: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of ranked lists ``(query_id, id, rank)``."""
    parts = [r.select("query_id", "id", (F.lit(1.0) / (F.lit(c) + F.col("rank"))).alias("_rr"),
                      F.col("rank").alias(f"rank_{i}")) for i, r in enumerate(ranked)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    g = u.groupBy("query_id", "id").agg(F.sum("_rr").alias("score"),
                                         *[F.min(f"rank_{i}").alias(f"rank_{i}") for i in range(len(ranked))])
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hybrid_search(queries: DataFrame, corpus: DataFrame | None, k: int = 10, depth: int | None = None,
                  qid_col: str = "query_id", qtext: str = "text", id_col: str = "doc_id",
                  text: str = "text", dims: int = 256, index: LexicalIndex | None = None, vectors: VectorIndex | None = None,
                  probes: int | None = None) -> DataFrame:
    """BM25 and vector top-``depth`` lists fused by reciprocal rank; keep k.
    ``rank_0`` is the lexical rank, ``rank_1`` the vector rank (null when
    the document was not in that list).

    A stored ``index`` of the corpus, and stored ``vectors`` of its texts'
    embeddings, take the place of tokenizing and embedding it; with both the
    corpus itself is not read."""
    depth = depth or k
    lex = index.search(queries, depth, qid_col, qtext) if index else bm25_search(queries, corpus, depth, qid_col, qtext, id_col, text)
    if vectors:
        q = embed(queries.select(F.col(qid_col).alias("query_id"), F.col(qtext).alias("text")), "text", dims, id_col="query_id")
        # a text without words has no direction: it is near to nothing
        vec = vectors.search(q.where(F.exists("embedding", lambda x: x != 0)), depth, probes=probes)
    else:
        vec = dense_search(queries, corpus, depth, qid_col, qtext, id_col, text, dims)
    return rrf(lex, vec, k=k)


def search_many(queries: DataFrame, corpora: dict[str, DataFrame], k: int = 10, **kw) -> DataFrame:
    """Search each collection (BM25), merge, and keep the k best per query
    across collections (score desc, collection, id)."""
    parts = [bm25_search(queries, c, k, **kw).withColumn("collection", F.lit(name)) for name, c in corpora.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.withColumnRenamed("rank", "collection_rank")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("collection"), F.col("id"))
    return u.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def restrict(corpus: DataFrame, grants: DataFrame, user: str | None = None,
             roles: Sequence[str] = (), collection_col: str = "collection") -> DataFrame:
    """Rows of collections the caller may search: a grant for the user, or
    for one of the roles, with permission ``search`` (semi join)."""
    from tessera.operators.joins import bounded_broadcast

    return corpus.join(bounded_broadcast(granted(grants, user, roles, collection_col)), on=collection_col, how="left_semi")


def granted(grants: DataFrame, user: str | None = None, roles: Sequence[str] = (), collection_col: str = "collection") -> DataFrame:
    """Collections that the caller may search, one row each."""
    cond = F.lit(False)
    if user is not None:
        cond = cond | ((F.col("subject_type") == "user") & (F.col("subject_id") == user))
    if roles:
        cond = cond | ((F.col("subject_type") == "role") & F.col("subject_id").isin(list(roles)))
    return grants.filter(cond & (F.col("permission") == "search")).select(F.col("collection_id").alias(collection_col)).distinct()


def pack_context(hits: DataFrame, budget: int = 2000, text_col: str = "text", rank_col: str = "rank",
                 by: Sequence[str] = ("query_id",), spent_col: str | None = None, chunk_col: str | None = None) -> DataFrame:
    """Fill a token budget with ranked chunks (per query, bounded by k).
    ``spent_col`` names tokens of the budget that are gone already; the values
    of ``chunk_col`` are listed as ``chunks``, by rank.

    The context is ``[1] text`` blocks with a blank line between them, and the
    budget holds for all of it: marks and blank lines count (4 characters a
    token, rounded up per block). Blocks are taken whole while the running sum
    fits; the one that crosses the budget is cut to the tokens left and marked
    truncated, or skipped if nothing of its text would be left; later ones are
    skipped. Output one row per query: the context, tokens used and the three
    counts.
    """
    order = Window.partitionBy(*by).orderBy(F.col(rank_col))
    n = F.row_number().over(order)
    h = hits.withColumn("_mark", F.concat(F.when(n > 1, "\n\n").otherwise(""), F.lit("["), n.cast("string"), F.lit("] ")))
    h = h.withColumn("_block", F.concat("_mark", F.coalesce(F.col(text_col), F.lit(""))))
    h = h.withColumn("_tok", F.ceil(F.char_length("_block") / F.lit(4.0)).cast("long"))
    h = h.withColumn("_cum", F.sum("_tok").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    budget = F.lit(budget) if spent_col is None else F.lit(budget) - F.coalesce(F.col(spent_col), F.lit(0))
    left = budget - F.col("_cum") + F.col("_tok")
    h = h.withColumn("_state", F.when(F.col("_cum") <= budget, F.lit("whole"))
                     .when(left * 4 > F.char_length("_mark"), F.lit("truncated")).otherwise(F.lit("skipped")))
    h = h.withColumn("_text", F.when(F.col("_state") == "whole", F.col("_block"))
                     .when(F.col("_state") == "truncated", F.substring(F.col("_block"), F.lit(1), (left * 4).cast("int"))))
    h = h.withColumn("_used", F.when(F.col("_state") == "whole", F.col("_tok"))
                     .when(F.col("_state") == "truncated", left).otherwise(F.lit(0)))
    by_rank = lambda c: F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(c).alias("c"))), lambda a, b: (a["r"] - b["r"]).cast("int"))
    listed = [F.transform(by_rank(chunk_col), lambda x: x["c"]).alias("chunks")] if chunk_col else []
    g = h.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.when(F.col("_state") != "skipped", F.struct(F.col(rank_col).alias("r"), F.col("_text").alias("t"))))).alias("_l"),
        F.sum("_used").cast("long").alias("tokens_used"),
        F.sum(F.when(F.col("_state") == "whole", 1).otherwise(0)).cast("long").alias("n_included"),
        F.sum(F.when(F.col("_state") == "truncated", 1).otherwise(0)).cast("long").alias("n_truncated"),
        F.sum(F.when(F.col("_state") == "skipped", 1).otherwise(0)).cast("long").alias("n_skipped"),
        *listed)
    return g.withColumn("context", F.array_join(F.transform("_l", lambda s: s["t"]), "")).drop("_l")


def rerank_score(hits: DataFrame, k: int = 5, by: Sequence[str] = ("query_id",), qtext: str = "query_text",
                 dtext: str = "text", dims: int = 256) -> DataFrame:
    """Re-score candidates (ours, no cross-encoder): 0.5 x cosine of hashed
    embeddings + 0.5 x share of query terms found in the document; keep k."""
    e = embed(hits, qtext, dims, out="_qe")
    e = embed(e.drop("model", "dimensions"), dtext, dims, out="_de").drop("model", "dimensions")
    qt = F.array_distinct(word_tokens(F.col(qtext)))
    dt = F.array_distinct(word_tokens(F.col(dtext)))
    share = F.when(F.size(qt) > 0, F.size(F.array_intersect(qt, dt)) / F.size(qt)).otherwise(F.lit(0.0))
    s = e.withColumn("rerank_score", F.round(0.5 * cosine(F.col("_qe"), F.col("_de")) + 0.5 * share, 6)).drop("_qe", "_de")
    w = Window.partitionBy(*by).orderBy(F.col("rerank_score").desc(), F.col("id").asc())
    return s.withColumn("rerank", F.row_number().over(w)).filter(F.col("rerank") <= k)
