"""Document jobs, retrieval and vector queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import migration as MG
from tessera.operators import retrieval as RT
from tessera.operators import text as TX
from tessera.operators import vectors as V
from tessera.operators.joins import judge
from tessera.operators.lexindex import LexicalIndex
from tessera.operators.vecindex import VectorIndex
from tessera.queries import query
from tessera.session import Tables
from tessera.sources import files as S
from tessera.sources.versioned import VersionedTable
from tessera.streaming import streams as ST

TOK_SQL = r"list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"

# ------------------------------------------------------------------ chunking


@query("chunk_fixed", """
SELECT doc_id, CAST(s / 462 AS INTEGER) AS chunk_no, CAST(s AS INTEGER) AS start, substr(text, s + 1, 512) AS chunk
FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 50 - 1, 0), 462)) AS s FROM documents)
""")
def chunk_fixed(spark, d):
    return TX.chunk_fixed(Tables(spark, d).documents, "text", 512, 50)


@query("chunk_token", r"""
SELECT doc_id, CAST(s / 90 AS INTEGER) AS chunk_no, CAST(s AS INTEGER) AS start,
  array_to_string(w[s + 1 : s + 100], ' ') AS chunk
FROM (SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - 10 - 1, 0), 90)) AS s FROM
  (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents))
""")
def chunk_token(spark, d):
    return TX.chunk_token(Tables(spark, d).documents, "text", 100, 10)


@query("chunk_recursive", None)
def chunk_recursive(spark, d):
    return TX.chunk_recursive(Tables(spark, d).documents, "text", 512, 50)


@query("chunk_semantic", None)
def chunk_semantic(spark, d):
    return TX.chunk_semantic(Tables(spark, d).documents, "text", threshold=0.1)


@query("parse_html", None)
def parse_html(spark, d):
    return TX.parse_html(Tables(spark, d).pages, "html", "page_id")


def _markdown(spark, d):
    # stand-in markdown: short lines of a document are written as headings
    docs = Tables(spark, d).documents
    md = F.array_join(F.transform(F.split("text", "\n"), lambda l: F.when(
        F.char_length(l) < 60, F.concat(F.lit("## "), l)).otherwise(l)), "\n")
    return docs.select("doc_id", md.alias("text"))


@query("parse_markdown", r"""
WITH md AS (SELECT doc_id, array_to_string(list_transform(string_split(text, E'\n'),
    lambda l: CASE WHEN length(l) < 60 THEN '## ' || l ELSE l END), E'\n') AS text FROM documents),
ln AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line,
         unnest(range(len(regexp_split_to_array(text, '\r?\n')))) AS line_no FROM md),
h AS (SELECT *, regexp_extract(line, '^(#{1,6})\s+(.*)$', 1) AS m FROM ln),
c AS (SELECT *, last_value(CASE WHEN m <> '' THEN line_no END IGNORE NULLS) OVER
        (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sec FROM h),
heads AS (SELECT doc_id, line_no AS sec, regexp_extract(line, '^(#{1,6})\s+(.*)$', 2) AS heading,
            length(m) AS level FROM h WHERE m <> '')
SELECT c.doc_id, CAST(coalesce(c.sec, -1) AS INTEGER) AS section_line, heads.heading, heads.level,
  string_agg(c.line, E'\n' ORDER BY c.line_no) AS body
FROM c LEFT JOIN heads ON c.doc_id = heads.doc_id AND c.sec = heads.sec
WHERE c.m = '' GROUP BY c.doc_id, c.sec, heads.heading, heads.level
""")
def parse_markdown(spark, d):
    p = TX.parse_markdown(_markdown(spark, d), "text", "doc_id")
    return p.select("doc_id", F.col("section_line").cast("int").alias("section_line"), "heading",
                    F.col("level").cast("long").alias("level"), "body")


EXTRACT = [
    {"name": "email", "pattern": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[a-z]{2,})", "type": "str"},
    {"name": "token", "pattern": r'token = "([0-9a-f]{40})"', "type": "str"},
    {"name": "ip", "pattern": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", "type": "str"},
    {"name": "version", "pattern": r"Version (\d+\.\d+)", "type": "float"},
    {"name": "card", "pattern": r"(\d{16})", "type": "int"},
    {"name": "licensed", "pattern": r"(Licensed|License)", "type": "bool"},
]


@query("extract_metadata", r"""
SELECT doc_id,
  CASE WHEN regexp_matches(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[a-z]{2,})') THEN regexp_extract(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[a-z]{2,})', 1) END AS email,
  CASE WHEN regexp_matches(text, 'token = "([0-9a-f]{40})"') THEN regexp_extract(text, 'token = "([0-9a-f]{40})"', 1) END AS token,
  CASE WHEN regexp_matches(text, '\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}') THEN regexp_extract(text, '\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}', 0) END AS ip,
  CASE WHEN regexp_matches(text, 'Version (\d+\.\d+)') THEN CAST(regexp_extract(text, 'Version (\d+\.\d+)', 1) AS DOUBLE) END AS version,
  CASE WHEN regexp_matches(text, '(\d{16})') THEN CAST(regexp_extract(text, '(\d{16})', 1) AS BIGINT) END AS card,
  CASE WHEN regexp_matches(text, '(Licensed|License)') THEN lower(regexp_extract(text, '(Licensed|License)', 1)) IN ('true', '1', 'yes') END AS licensed
FROM documents
""")
def extract_metadata(spark, d):
    e = TX.extract_fields(Tables(spark, d).documents, "text", EXTRACT)
    return e.select("doc_id", *[f["name"] for f in EXTRACT])


_INVOICE_SCHEMA = {"type": "object", "properties": {
    "invoice": {"type": "string"},
    "line_items": {"type": "array", "items": {"type": "object", "properties": {
        "desc": {"type": "string"}, "amount": {"type": "number"}}}}}, "required": ["invoice", "line_items"]}


def _replies(spark, d):
    # stand-in structured replies: one JSON answer per order
    o = Tables(spark, d).orders
    body = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("invoice"), F.array(
        F.struct(F.col("o_orderpriority").alias("desc"), F.col("o_totalprice").alias("amount")),
        F.struct(F.col("o_orderstatus").alias("desc"), (F.col("o_totalprice") * 0.1).alias("amount"))
    ).alias("line_items")))
    return o.select("o_orderkey", body.alias("reply"))


_REPLIES_SQL = """(SELECT o_orderkey, json_object('invoice', CAST(o_orderkey AS VARCHAR), 'line_items', json_array(
    json_object('desc', o_orderpriority, 'amount', o_totalprice),
    json_object('desc', o_orderstatus, 'amount', o_totalprice * 0.1))) AS reply FROM orders)"""
_PARSED_SQL = f"""(SELECT o_orderkey, from_json(reply,
    '{{"invoice":"VARCHAR","line_items":[{{"desc":"VARCHAR","amount":"DOUBLE"}}]}}') AS v FROM {_REPLIES_SQL})"""


@query("extract_table", f"""
SELECT o_orderkey, li.desc AS "desc", li.amount AS amount FROM (SELECT o_orderkey, unnest(v.line_items) AS li FROM {_PARSED_SQL})
""")
def extract_table(spark, d):
    return TX.extract_table(_replies(spark, d), "reply", _INVOICE_SCHEMA, keep=["o_orderkey"])


@query("invoice_table", f"""
SELECT inv AS invoice, li.desc AS line_desc, li.amount AS line_amount
FROM (SELECT v.invoice AS inv, unnest(v.line_items) AS li FROM {_PARSED_SQL})
""")
def invoice_table(spark, d):
    from tessera.plans.flows import invoice_table as flow

    return flow(_replies(spark, d), "reply", _INVOICE_SCHEMA, ["invoice", "line_items[].desc", "line_items[].amount"])


@query("load_documents", "SELECT doc_id, lang, source, n_chars FROM documents")
def load_documents(spark, d):
    docs = S.load_documents(spark, f"{d}/documents.parquet", "parquet")
    return docs.select("doc_id", "lang", "source", "n_chars")


# ------------------------------------------------------------------ retrieval

_CENTROID_SQL = """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ex AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS dim FROM e),
c AS (SELECT label, list(m ORDER BY dim) AS cv FROM (SELECT label, dim, avg(x) AS m FROM ex GROUP BY label, dim) GROUP BY label)"""


#: every vector whose id is divisible by 50, against all of them
_NEAREST_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_cosine_similarity(e.v, q.v) AS score FROM e, e AS q WHERE q.vec_id % 50 = 0)
SELECT query_id, id, round(score, 4) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s) WHERE rank <= 10
"""


def _vectors(spark, d):
    """(queries, all vectors)"""
    emb = Tables(spark, d).embeddings.select(F.col("vec_id").alias("id"), "embedding")
    return emb.filter(F.col("id") % 50 == 0).withColumnRenamed("id", "query_id"), emb


def _rounded(hits):
    return hits.select("query_id", "id", F.round("score", 4).alias("score"), "rank")


@query("vector_search", _NEAREST_SQL)
def vector_search(spark, d):
    q, emb = _vectors(spark, d)
    return _rounded(V.vector_search(q, emb, k=10))


def _vector_index(spark, d):
    """Stored in two additions; every third vector first with a wrong value and under a wrong id, then replaced and removed."""
    q, emb = _vectors(spark, d)
    ix = VectorIndex.create(spark, ST.scratch_path(spark, "vector-index"), emb)
    third = emb.filter(F.col("id") % 3 == 0)
    wrong = third.withColumn("id", -F.col("id") - 1)
    ix.add(third.withColumn("embedding", F.reverse("embedding")).unionByName(wrong))
    ix.add(emb)
    ix.remove(wrong)
    return q, ix


@query("ann_index_all_lists", _NEAREST_SQL)
def ann_index_all_lists(spark, d):
    q, ix = _vector_index(spark, d)
    return _rounded(ix.search(q, k=10, probes=len(ix.centres)))


_BM25_SQL = f"""
q AS (SELECT item_id AS query_id, unnest(list_distinct({TOK_SQL.format(c='text')})) AS term FROM benchmark),
d AS (SELECT doc_id, {TOK_SQL.format(c='text')} AS toks FROM documents),
stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
dt AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM d),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT q.query_id, tf.doc_id AS id,
  sum(ln(1 + (stats.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / stats.avgdl))) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN df ON df.term = q.term CROSS JOIN stats GROUP BY ALL),
bm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM sc) WHERE rank <= 10)"""


def _bm25(spark, d, k=10):
    t = Tables(spark, d)
    return RT.bm25_search(t.benchmark.withColumnRenamed("item_id", "query_id"), t.documents, k)


@query("bm25_search", f"WITH {_BM25_SQL} SELECT query_id, id, round(score, 4) AS score, rank FROM bm")
def bm25_search(spark, d):
    return _bm25(spark, d).select("query_id", "id", F.round("score", 4).alias("score"), "rank")


def _emb_sql(n, table, id_col):
    """Hashed-word vectors of a table's texts as ``{n}v (id, dim, x)``, zeros left out."""
    return rf"""
{n}h AS (SELECT {id_col} AS id, md5(unnest({TOK_SQL.format(c='text')})) AS m FROM {table}),
{n}b AS (SELECT id, CAST('0x' || substr(m, 1, 7) AS BIGINT) % 256 AS dim,
  sum(CASE WHEN substr(m, 8, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS x FROM {n}h GROUP BY ALL),
{n}v AS (SELECT id, dim, (x / sqrt(sum(x * x) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS x FROM {n}b WHERE x <> 0)"""


#: cosine of every query and document that share a dimension
_COS_SQL = f"""{_emb_sql('q', 'benchmark', 'item_id')},{_emb_sql('d', 'documents', 'doc_id')},
nq AS (SELECT id, sqrt(sum(x * x)) AS n FROM qv GROUP BY id), nd AS (SELECT id, sqrt(sum(x * x)) AS n FROM dv GROUP BY id),
cos AS (SELECT p.query_id, p.id, p.dot / (nq.n * nd.n) AS score FROM (
  SELECT qv.id AS query_id, dv.id AS id, sum(qv.x * dv.x) AS dot FROM qv JOIN dv USING (dim) GROUP BY ALL) p
  JOIN nq ON nq.id = p.query_id JOIN nd ON nd.id = p.id)"""
_BM25_20_SQL = _BM25_SQL.replace("rank <= 10", "rank <= 20")


@query("hybrid_search", f"""
WITH {_BM25_20_SQL}, {_COS_SQL},
vec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM cos) WHERE rank <= 20),
fused AS (SELECT query_id, id, coalesce(1.0::DOUBLE / (60 + bm.rank), 0) + coalesce(1.0::DOUBLE / (60 + vec.rank), 0) AS score,
  bm.rank AS rank_0, vec.rank AS rank_1 FROM bm FULL JOIN vec USING (query_id, id))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fused) WHERE rank <= 10
""")
def hybrid_search(spark, d):
    t = Tables(spark, d)
    return RT.hybrid_search(t.benchmark.withColumnRenamed("item_id", "query_id"), t.documents, k=10, depth=20)


#: documents of which some were replaced by shorter versions and some removed
_CHANGED_SQL = """corpus AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN substr(text, 1, 300) ELSE text END AS text, lang
  FROM documents WHERE doc_id % 7 <> 3)"""


@query("index_search", f"""WITH {_CHANGED_SQL}, {_BM25_SQL.replace("FROM documents", "FROM corpus")}
SELECT query_id, id, round(score, 4) AS score, rank FROM bm""")
def index_search(spark, d):
    t = Tables(spark, d)
    docs = t.documents.select("doc_id", "text", "lang")
    ix = LexicalIndex.create(spark, ST.scratch_path(spark, "lexical-index"))
    for rest in (0, 1):
        ix.add(docs.filter(F.col("doc_id") % 2 == rest), collection="lang", writer=("ingest", rest))
    ix.add(docs.filter(F.col("doc_id") % 10 == 0).withColumn("text", F.substring("text", 1, 300)), collection="lang", writer=("ingest", 2))
    ix.remove(docs.filter(F.col("doc_id") % 7 == 3).select("doc_id"), "doc_id")
    return _rounded(LexicalIndex.open(spark, ix.path).search(t.benchmark.withColumnRenamed("item_id", "query_id")))


def _index(spark, d):
    """Every document, in the collection of its language."""
    ix = LexicalIndex.create(spark, ST.scratch_path(spark, "lexical-index"))
    ix.add(Tables(spark, d).documents.select("doc_id", "text", "lang"), collection="lang")
    return ix


@query("multi_collection_search", rf"""
WITH q AS (SELECT item_id AS query_id, unnest(list_distinct({TOK_SQL.format(c='text')})) AS term FROM benchmark),
d AS (SELECT doc_id, lang, {TOK_SQL.format(c='text')} AS toks FROM documents),
stats AS (SELECT lang, count(*) AS n, avg(len(toks)) AS avgdl FROM d GROUP BY lang),
dt AS (SELECT doc_id, lang, len(toks) AS dl, unnest(toks) AS term FROM d),
tf AS (SELECT doc_id, lang, dl, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT lang, term, count(*) AS df FROM tf GROUP BY lang, term),
sc AS (SELECT q.query_id, tf.lang AS collection, tf.doc_id AS id,
  sum(ln(1 + (stats.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / stats.avgdl))) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN df ON df.term = q.term AND df.lang = tf.lang JOIN stats ON stats.lang = tf.lang GROUP BY ALL),
per AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, collection ORDER BY round(score, 9) DESC, id) AS cr FROM sc) WHERE cr <= 10)
SELECT query_id, collection, id, round(score, 4) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, collection, id) AS rank FROM per) WHERE rank <= 10
""")
def multi_collection_search(spark, d):
    # one index, one run over it for all collections
    q = Tables(spark, d).benchmark.withColumnRenamed("item_id", "query_id")
    r = _index(spark, d).search(q, k=10, per_collection=True)
    return r.select("query_id", "collection", "id", F.round("score", 4).alias("score"), "rank")


def _grants(spark):
    # fixed grants of the fixture: role support -> en, fr; role legal -> de
    rows = [("en", "role", "support", "search"), ("fr", "role", "support", "search"),
            ("de", "role", "legal", "search"), ("es", "role", "legal", "read")]
    return spark.createDataFrame(rows, "collection_id string, subject_type string, subject_id string, permission string")


@query("permission_search", f"""
WITH corpus AS (SELECT * FROM documents WHERE lang IN ('en', 'fr')), {_BM25_SQL.replace("FROM documents", "FROM corpus")}
SELECT query_id, id, lang, round(score, 4) AS score, rank FROM bm JOIN documents ON doc_id = id
""")
def permission_search(spark, d):
    # a search of the granted collections, by their own figures: no better hit of another collection takes a place
    t = Tables(spark, d)
    r = _index(spark, d).search(t.benchmark.withColumnRenamed("item_id", "query_id"), k=10,
                                collections=RT.granted(_grants(spark), user="u1", roles=["support"]))
    lang = t.documents.select(F.col("doc_id").alias("id"), "lang")
    return r.join(lang, "id").select("query_id", "id", "lang", F.round("score", 4).alias("score"), "rank")


#: mark of the n-th block of a context
_MARK_SQL = "CASE WHEN rank > 1 THEN E'\\n\\n' ELSE '' END || '[' || CAST(rank AS VARCHAR) || '] '"
#: packs rows ``m (query_id, rank, mark, text)`` into 2000 tokens
_PACK_SQL = """
h AS (SELECT query_id, rank, mark, mark || coalesce(text, '') AS text, CAST(ceil(length(mark || coalesce(text, '')) / 4.0) AS BIGINT) AS tok FROM m),
c AS (SELECT *, sum(tok) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM h),
s AS (SELECT *, CASE WHEN cum <= 2000 THEN 'whole' WHEN (2000 - (cum - tok)) * 4 > length(mark) THEN 'truncated' ELSE 'skipped' END AS st,
        2000 - (cum - tok) AS lft FROM c)
SELECT query_id,
  CAST(sum(CASE st WHEN 'whole' THEN tok WHEN 'truncated' THEN lft ELSE 0 END) AS BIGINT) AS tokens_used,
  CAST(sum(CASE WHEN st = 'whole' THEN 1 ELSE 0 END) AS BIGINT) AS n_included,
  CAST(sum(CASE WHEN st = 'truncated' THEN 1 ELSE 0 END) AS BIGINT) AS n_truncated,
  CAST(sum(CASE WHEN st = 'skipped' THEN 1 ELSE 0 END) AS BIGINT) AS n_skipped,
  string_agg(CASE WHEN st = 'whole' THEN text WHEN st = 'truncated' THEN substr(text, 1, CAST(lft * 4 AS INTEGER)) END, '' ORDER BY rank) AS context
FROM s GROUP BY query_id"""


@query("pack_context", f"""
WITH {_BM25_SQL},
m AS (SELECT bm.query_id, bm.rank, {_MARK_SQL} AS mark, docs.text FROM bm JOIN documents docs ON docs.doc_id = bm.id),{_PACK_SQL}
""")
def pack_context(spark, d):
    t = Tables(spark, d)
    hits = _bm25(spark, d).join(t.documents.select(F.col("doc_id").alias("id"), "text"), "id")
    p = RT.pack_context(hits, 2000)
    return p.select("query_id", "tokens_used", "n_included", "n_truncated", "n_skipped", "context")


@query("qrels_join", f"""
WITH {_BM25_SQL},
qrels AS (SELECT b.item_id AS query_id, docs.doc_id AS id FROM benchmark b JOIN documents docs ON contains(docs.text, b.text))
SELECT bm.query_id, bm.id, bm.rank, EXISTS (SELECT 1 FROM qrels WHERE qrels.query_id = bm.query_id AND qrels.id = bm.id) AS relevant
FROM bm
""")
def qrels_join(spark, d):
    t = Tables(spark, d)
    qrels = TX.citation_matches(t.benchmark.select(F.col("item_id").alias("cite_id"), "text"),
                                t.documents.select("doc_id", "text"))
    j = judge(_bm25(spark, d), qrels.select(F.col("cite_id").alias("query_id"), F.col("doc_id").alias("id")))
    return j.select("query_id", "id", "rank", "relevant")


@query("recall_at_k", f"""
WITH {_BM25_SQL},
qrels AS (SELECT DISTINCT b.item_id AS query_id, docs.doc_id AS id FROM benchmark b JOIN documents docs ON contains(docs.text, b.text)),
tot AS (SELECT query_id, count(*) AS relevant FROM qrels GROUP BY query_id),
got AS (SELECT bm.query_id, count(*) AS found FROM bm JOIN qrels ON qrels.query_id = bm.query_id AND qrels.id = bm.id GROUP BY bm.query_id)
SELECT tot.query_id, tot.relevant, coalesce(got.found, 0) AS found, round(coalesce(got.found, 0) / tot.relevant, 4) AS recall
FROM tot LEFT JOIN got ON tot.query_id = got.query_id
""")
def recall_at_k(spark, d):
    t = Tables(spark, d)
    qrels = TX.citation_matches(t.benchmark.select(F.col("item_id").alias("cite_id"), "text"),
                                t.documents.select("doc_id", "text"))
    r = V.recall_at_k(_bm25(spark, d), qrels.select("cite_id", "doc_id"), k=10)
    return r.select("query_id", "relevant", "found", "recall")


@query("rerank_lexical", f"""
WITH {_BM25_20_SQL}, {_COS_SQL},
qt AS (SELECT item_id AS query_id, list_distinct({TOK_SQL.format(c='text')}) AS qw FROM benchmark),
dw AS (SELECT doc_id AS id, list_distinct({TOK_SQL.format(c='text')}) AS w FROM documents WHERE doc_id IN (SELECT id FROM bm)),
s AS (SELECT bm.query_id, bm.id, bm.rank, round(0.5::DOUBLE * coalesce(cos.score, 0) +
    0.5::DOUBLE * CASE WHEN len(qw) > 0 THEN len(list_intersect(qw, w)) / len(qw) ELSE 0 END, 6) AS rerank_score
  FROM bm JOIN qt USING (query_id) JOIN dw ON dw.id = bm.id LEFT JOIN cos ON cos.query_id = bm.query_id AND cos.id = bm.id)
SELECT query_id, id, rank, rerank, rerank_score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, id) AS rerank FROM s) WHERE rerank <= 5
""")
def rerank_lexical(spark, d):
    t = Tables(spark, d)
    hits = _bm25(spark, d, 20).join(t.documents.select(F.col("doc_id").alias("id"), "text"), "id") \
        .join(t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text")), "query_id")
    return RT.rerank_score(hits, k=5).select("query_id", "id", "rank", "rerank", "rerank_score")


# ------------------------------------------------------------------ vectors


@query("embed_text", f"""
WITH {_emb_sql('d', 'documents', 'doc_id')}
SELECT doc_id, 'hashed-words' AS model, 256 AS dimensions, round(coalesce(sqrt(sum(x * x)), 0), 4) AS norm,
  count(x) AS n_nonzero, round(coalesce(sum(x * (dim + 1)), 0), 3) AS checksum
FROM documents LEFT JOIN dv ON dv.id = doc_id GROUP BY doc_id
""")
def embed_text(spark, d):
    docs = Tables(spark, d).documents
    e = V.embed(docs, "text", 256, id_col="doc_id")
    placed = F.transform("embedding", lambda x, i: x.cast("double") * (i + 1))
    return e.select("doc_id", "model", "dimensions", F.round(V.norm(F.col("embedding")), 4).alias("norm"),
                    F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("n_nonzero"),
                    F.round(F.aggregate(placed, F.lit(0.0), lambda a, x: a + x), 3).alias("checksum"))


def _pairs(spark, d):
    # stand-in pairs: each vector with the next vector id
    e = Tables(spark, d).embeddings
    a = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("va"))
    b = e.select(F.col("vec_id").alias("b"), F.col("embedding").alias("vb"))
    return a.join(b, F.col("b") == F.col("a") + 1)


@query("similarity", """
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def similarity(spark, d):
    s = V.similarity(_pairs(spark, d), "va", "vb")
    return s.select("a", "b", F.round("score", 4).alias("score"))


@query("cluster", None)
def cluster(spark, d):
    e = Tables(spark, d).embeddings
    out, _ = V.cluster(e, k=5, seed=1)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("classify", f"""
WITH {_CENTROID_SQL},
s AS (SELECT e.vec_id, c.label, list_cosine_similarity(e.v, c.cv) AS cos FROM e, c)
SELECT vec_id, CAST(arg_max(label, cos) AS VARCHAR) AS predicted, round(max(cos), 4) AS score FROM s GROUP BY vec_id
""")
def classify(spark, d):
    e = Tables(spark, d).embeddings
    lv = V.centroids(e, "label")
    c = V.classify(e, lv, "label")
    return c.select("vec_id", "predicted", F.round("score", 4).alias("score"))


def _second_space(spark, d):
    """Stand-in second vector space: coordinates reversed plus a small
    deterministic noise from a hash of (id, position)."""
    e = Tables(spark, d).embeddings
    place = lambda i: F.md5(F.concat_ws(":", F.col("vec_id").cast("string"), i.cast("string")).cast("binary"))
    noise = lambda x, i: x.cast("double") + (F.conv(F.substring(place(i), 1, 7), 16, 10).cast("long") % 1000 - 500) / 1e6
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("source"),
                    F.transform(F.reverse("embedding"), noise).alias("target"))


#: cosine of each vector in reverse to its stand-in; a map fitted on the pairs comes within three places of the reversal
_REVERSED_SQL = """
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i, unnest(list_reverse(embedding))::DOUBLE AS r FROM embeddings),
y AS (SELECT vec_id, r, r + (CAST('0x' || substr(md5(vec_id || ':' || i), 1, 7) AS BIGINT) % 1000 - 500) / 1e6 AS y FROM v)
SELECT vec_id AS id, round(sum(r * y) / sqrt(sum(r * r) * sum(y * y)), 3) AS {name} FROM y GROUP BY vec_id
"""


@query("project_vectors", _REVERSED_SQL.format(name="cos_to_target"))
def project_vectors(spark, d):
    # the map comes from the data (a ridge fit), then every vector is projected
    p = _second_space(spark, d)
    w = V.fit_ridge(p, 1e-3)
    out = V.project(p, w, vec_col="source", out="projected")
    return out.select("id", F.round(V.cosine(F.col("projected"), F.col("target")), 3).alias("cos_to_target"))


def _one_row(spark, values: dict):
    return spark.createDataFrame([tuple(values.values())], list(values.keys()))


@query("fit_ridge", None)
def fit_ridge(spark, d):
    p = _second_space(spark, d)
    w = V.fit_ridge(p, 1e-3)
    # residual of the fitted map over all pairs (a Spark job over the table)
    proj = V.project(p.select("source", "target"), w, vec_col="source", out="_p")
    rms = proj.select(F.sqrt(F.avg(F.aggregate(F.zip_with("_p", "target", lambda a, b: (a - b) * (a - b)),
                                               F.lit(0.0), lambda acc, x: acc + x)))).first()[0]
    return _one_row(spark, {"dims": int(w.shape[0]), "rms_residual": round(float(rms), 6)})


@query("fit_procrustes", None)
def fit_procrustes(spark, d):
    p = _second_space(spark, d)
    w = V.fit_procrustes(p)
    return _one_row(spark, {"dims": int(w.shape[0]), "orthogonality_error": round(float(np.abs(w @ w.T - np.eye(w.shape[0])).max()), 6)})


@query("cka", """
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i, unnest(list_reverse(embedding))::DOUBLE AS r FROM embeddings),
y AS (SELECT vec_id, i, x, r + (CAST('0x' || substr(md5(vec_id || ':' || i), 1, 7) AS BIGINT) % 1000 - 500) / 1e6 AS y FROM v),
c AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS x, y - avg(y) OVER (PARTITION BY i) AS y FROM y),
g AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS xx, sum(a.x * b.y) AS xy, sum(a.y * b.y) AS yy FROM c a JOIN c b USING (vec_id) GROUP BY ALL)
SELECT round(sum(xy * xy) / (sqrt(sum(xx * xx)) * sqrt(sum(yy * yy))), 4) AS cka FROM g
""")
def cka(spark, d):
    return _one_row(spark, {"cka": round(V.cka(_second_space(spark, d)), 4)})


@query("migration_feasibility", None)
def migration_feasibility(spark, d):
    f = V.feasibility(_second_space(spark, d))
    return _one_row(spark, {k: (round(v, 4) if isinstance(v, float) else v) for k, v in f.items()})


@query("migrate_vectors", _REVERSED_SQL.format(name="retention"))
def migrate_vectors(spark, d):
    p = _second_space(spark, d)
    w = V.fit_procrustes(p)
    src = p.select("id", F.col("source").alias("embedding"))
    target = VersionedTable.create(spark, ST.scratch_path(spark, "migrated"), "id long, embedding array<double>", "id")
    job = MG.Migration(src, w, target, "job", ranges=6, truth=p.select("id", "target"))
    job.run(stop_after=3)  # ended after three ranges
    MG.Migration(src, w, target, "job", ranges=6, truth=p.select("id", "target")).run()  # started again: the other three
    moved = target.read().select("id", F.col("embedding").alias("projected")).join(p.select("id", "target"), "id")
    return moved.select("id", F.round(V.cosine(F.col("projected"), F.col("target")), 3).alias("retention"))


@query("quantize_sq8", """
WITH ex AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM embeddings),
r AS (SELECT dim, CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM ex GROUP BY dim),
c AS (SELECT ex.vec_id, ex.x, r.lo, r.hi, CASE WHEN r.hi > r.lo THEN CAST(least(255.0, greatest(0.0, round((ex.x - r.lo) / (r.hi - r.lo) * 255))) AS INTEGER) ELSE 0 END AS code
      FROM ex JOIN r ON ex.dim = r.dim)
SELECT vec_id, CAST(sum(code) AS BIGINT) AS code_sum, round(max(abs(lo + code * (hi - lo) / 255.0 - x)), 4) AS max_err FROM c GROUP BY vec_id
""")
def quantize_sq8(spark, d):
    e = Tables(spark, d).embeddings
    q, _ = V.quantize_sq8(e)
    err = F.array_max(F.zip_with("restored", "embedding", lambda a, b: F.abs(a - b.cast("double"))))
    return q.select("vec_id", F.aggregate("codes", F.lit(0).cast("long"), lambda a, x: a + x).alias("code_sum"),
                    F.round(err, 4).alias("max_err"))


@query("ann_search", None)
def ann_search(spark, d):
    q, ix = _vector_index(spark, d)
    return ix.search(q, k=10)


@query("migration_quote", """
WITH n AS (SELECT 'embeddings' AS source, count(*) AS n, max(len(embedding)) AS dim FROM embeddings
  UNION ALL SELECT 'lines', CAST(sum(l_linenumber) AS BIGINT), 2 FROM lineitem),
r AS (SELECT * FROM (VALUES (true, 10), (false, 50)) t(retain, rate))
SELECT source, n AS n_total_vectors, dim AS src_dim, retain AS retain_on_cloud, rate AS rate_per_million_cents,
  CAST(ceil(greatest(n - 100000, 0) * rate / 1e6) AS BIGINT) AS quote_cents, ceil(greatest(n - 100000, 0) * rate / 1e6) / 100 AS quote_usd,
  n <= 100000 AS free_tier, n > 100000 AS requires_payment FROM n, r
""")
def migration_quote(spark, d):
    from tessera.operators.aggregates import quote

    t = Tables(spark, d)
    # a second source above the free tier: line n of an order makes n vectors
    lines = t.lineitem.select(F.explode(F.sequence(F.lit(1), F.col("l_linenumber"))), F.array("l_quantity", "l_extendedprice").alias("embedding"))
    parts = [quote(src, retain).withColumn("source", F.lit(name)) for name, src in (("embeddings", t.embeddings), ("lines", lines)) for retain in (True, False)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _drift_runs(spark, d):
    """Stand-in benchmark runs: one per event type and day, recall = mean
    value / 50 capped at 1; monitors are the event types."""
    e = Tables(spark, d).events
    runs = e.groupBy(F.col("event_type").alias("monitor_id"), F.to_date("ts").alias("day")).agg(
        F.least(F.lit(1.0), F.avg("value") / 50).alias("recall_at_10"), F.max("ts").alias("ts"))
    mons = e.select(F.col("event_type").alias("monitor_id")).distinct().withColumn(
        "min_recovery_r10", F.lit(0.9)).withColumn("cadence_hours", F.lit(24))
    return runs, mons


@query("drift_monitor", """
WITH runs AS (SELECT event_type AS monitor_id, CAST(ts AS DATE) AS day, least(1.0, avg(value) / 50) AS recall_at_10,
                max(ts) AS ts FROM events GROUP BY event_type, CAST(ts AS DATE)),
r AS (SELECT *, lag(recall_at_10) OVER (PARTITION BY monitor_id ORDER BY ts) AS prev,
        row_number() OVER (PARTITION BY monitor_id ORDER BY ts DESC) AS rn FROM runs)
SELECT monitor_id, round(recall_at_10, 6) AS recall_at_10, round(recall_at_10 / prev, 6) AS recovery,
  coalesce(recall_at_10 / prev < 0.9, false) AS alert, ts + INTERVAL 24 HOUR <= TIMESTAMP '2024-02-01 00:00:00' AS due
FROM r WHERE rn = 1
""")
def drift_monitor(spark, d):
    runs, mons = _drift_runs(spark, d)
    r = V.drift(runs, mons, now=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return r.select("monitor_id", F.round("recall_at_10", 6).alias("recall_at_10"), F.round("recovery", 6).alias("recovery"),
                    "alert", "due")


@query("decision_evidence", None)
def decision_evidence(spark, d):
    from tessera.plans.flows import decision_review

    t = Tables(spark, d)
    return decision_review(t.benchmark.withColumnRenamed("item_id", "issue_id"), t.documents, k=5)
