"""Vector and learning jobs: embedding, similarity, exact block top-k,
clustering, classification, projection, alignment fits, recall, drift and
8-bit quantisation.

Vectors are ``array<float>`` / ``array<double>`` columns. Element-wise math
stays in higher-order column functions (``zip_with``, ``aggregate``); numpy
runs only inside ``mapInPandas`` tasks for block matrix work, never on the
driver except for d x d matrices.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_BATCH_ROWS = 4096      # query vectors broadcast per corpus pass
SCORE_CELLS = 1 << 19        # scores (rows x queries) held at once by a task
DEFAULT_DIMS = 256

# --------------------------------------------------------------------------
# column math
# --------------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    d = norm(a) * norm(b)
    return F.when(d > 0, dot(a, b) / d).otherwise(F.lit(0.0))


def l2_normalize(a: Column) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


# --------------------------------------------------------------------------
# V1 embedding: hashed words (ours), a model plugs in the same way
# --------------------------------------------------------------------------


def word_tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def signed_buckets(text: Column, dims: int) -> Column:
    """Bucket (from 1) of each word of a text, negative if its sign is."""
    hashes = F.transform(word_tokens(text), lambda w: F.md5(w.cast("binary")))
    return F.transform(hashes, lambda h: (F.conv(F.substring(h, 1, 7), 16, 10).cast("long") % dims + 1) *
                       F.when(F.substring(h, 8, 1) < "8", 1).otherwise(-1))


@functools.lru_cache(maxsize=1 << 16)
def word_bucket(word: bytes) -> tuple[int, int]:
    """What :func:`signed_buckets` makes of a word: a number whose remainder by
    the dimensions is the bucket (from 0), and the sign."""
    head = int.from_bytes(hashlib.md5(word).digest()[:4], "big")  # eight hex digits
    return head >> 4, 1 if head & 15 < 8 else -1


def embed(df: DataFrame, text: str = "text", dims: int = DEFAULT_DIMS, id_col: str = "id",
          out: str = "embedding", model: str = "hashed-words") -> DataFrame:
    """Text to an L2-normalised ``dims``-wide vector (feature hashing, ours).

    Texts are cut into words JVM-side. A task names the words of a slice of rows
    by a dictionary, hashes each of its words once (:func:`word_bucket`) and adds
    the signs per row and bucket with ``numpy.bincount``. A real embedding model
    replaces this function with a ``mapInPandas`` over the same batches.
    """
    if dims < 1:
        raise ValueError("dims must be >= 1")

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def bucket_sum(col: pa.Array) -> pa.Array:
        parts, step = [], max(1, SCORE_CELLS // dims)
        for at in range(0, len(col), step):
            part = col.slice(at, step)
            sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
            words = part.flatten().dictionary_encode()
            named = np.array([word_bucket(w) for w in words.dictionary.cast(pa.binary()).to_pylist()], dtype=np.int64).reshape(-1, 2)
            signed = named[words.indices.to_numpy(zero_copy_only=False)]
            cell = np.repeat(np.arange(len(part)) * dims, sizes) + signed[:, 0] % dims
            v = np.bincount(cell, weights=signed[:, 1], minlength=len(part) * dims).astype(np.float64).reshape(len(part), dims)
            parts.append(unit_rows(v).astype(np.float32).ravel())
        flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1) * dims, pa.int32()), pa.array(flat, pa.float32()))

    return df.withColumn(out, bucket_sum(word_tokens(F.col(text)))).withColumn("model", F.lit(model)) \
        .withColumn("dimensions", F.lit(dims))


def similarity(df: DataFrame, a: str, b: str, out: str = "score") -> DataFrame:
    return df.withColumn(out, cosine(F.col(a), F.col(b)))


# --------------------------------------------------------------------------
# exact block top-k (J5 core)
# --------------------------------------------------------------------------


class Best:
    """The ``k`` best rows (score desc, id asc) of each of ``n`` queries over
    all blocks of scores that a task has seen; scores below ``least`` are no hits."""

    def __init__(self, n: int, k: int, least: float = -np.inf):
        self.k, self.floor = k, np.full(n, least)  # what a newcomer has to reach
        self.q, self.s, self.ids = np.empty(0, dtype=np.int64), np.empty(0), None

    def add(self, ids: np.ndarray, scores: np.ndarray, queries: np.ndarray | None = None) -> None:
        """Scores of ``ids`` (rows) for all queries, or for those given (columns)."""
        floor = self.floor if queries is None else self.floor[queries]
        if len(ids) > self.k:
            floor = np.maximum(floor, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        row, col = np.nonzero(scores >= floor)
        if not len(row):
            return
        q = np.concatenate((self.q, col if queries is None else queries[col]))
        s = np.concatenate((self.s, scores[row, col]))
        new = np.asarray(ids)[row]
        i = new if self.ids is None else np.concatenate((self.ids, new))
        names = np.unique(i, return_inverse=True)[1] if i.dtype == object else i
        order = np.lexsort((names, -s, q))
        q, s, i = q[order], s[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        full = place == self.k - 1
        self.floor[q[full]] = s[full]
        kept = place < self.k
        self.q, self.s, self.ids = q[kept], s[kept], i[kept]

    def rows(self, query_ids: Sequence) -> Iterator[pd.DataFrame]:
        if len(self.q):
            yield pd.DataFrame({"query_id": [query_ids[j] for j in self.q], "id": self.ids, "score": self.s})


def unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def query_blocks(queries: DataFrame, size: int) -> Iterator[list]:
    """Rows of a query table (id first) in blocks of about ``size``, by hash of
    the id; one block at a time is on the driver."""
    n = max(1, math.ceil(queries.count() / size))
    if n > 1:
        from tessera.session import cut_lineage

        queries = cut_lineage(queries)
    for i in range(n):
        rows = (queries if n == 1 else queries.filter(F.pmod(F.xxhash64(queries.columns[0]), F.lit(n)) == i)).collect()
        if rows:
            yield rows


def _keep_best(results: list[DataFrame], k: int, empty: DataFrame) -> DataFrame:
    found = empty
    for part in results:
        found = found.unionByName(part) if found is not empty else part
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _hit_schema(corpus: DataFrame, id_col: str, queries: DataFrame, qid_col: str) -> T.StructType:
    return T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType),
                         T.StructField("id", corpus.schema[id_col].dataType), T.StructField("score", T.DoubleType())])


def block_topk(corpus: DataFrame, queries: DataFrame, k: int, id_col: str = "id",
               vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "embedding",
               metric: str = "cosine") -> DataFrame:
    """Exact top-k per query without emitting all (query, doc) pairs.

    Query vectors are read in blocks of about ``QUERY_BATCH_ROWS`` (a hash
    split of the query ids; the number of blocks grows with the query set,
    never the size of one broadcast). Every corpus task scores slices of its
    rows against the query block with one matrix product and keeps the best
    ``k`` rows per query over all of its slices, so a task emits ``k`` rows per
    query at most; a window group limit then keeps the global ``k`` (score
    desc, id asc). Output ``(query_id, id, score, rank)``.
    """
    schema = _hit_schema(corpus, id_col, queries, qid_col)
    results = []
    for rows in query_blocks(queries.select(F.col(qid_col).alias("q"), F.col(qvec_col).alias("v")), QUERY_BATCH_ROWS):
        qmat = np.asarray([r["v"] for r in rows], dtype=np.float64)
        bq = corpus.sparkSession.sparkContext.broadcast(([r["q"] for r in rows], unit_rows(qmat) if metric == "cosine" else qmat))

        def run(batches: Iterator[pd.DataFrame], bq=bq) -> Iterator[pd.DataFrame]:
            qids, qm = bq.value
            best, step = Best(len(qids), k), max(k, SCORE_CELLS // len(qids))
            for pdf in batches:
                for at in range(0, len(pdf), step):
                    part = pdf.iloc[at:at + step]
                    m = np.vstack(part[vec_col].to_numpy()).astype(np.float64)
                    # rounded to 9 places so that ties are exact and broken by id
                    best.add(part[id_col].to_numpy(), np.round((unit_rows(m) if metric == "cosine" else m) @ qm.T, 9))
            yield from best.rows(qids)

        results.append(corpus.select(id_col, vec_col).mapInPandas(run, schema))
    return _keep_best(results, k, corpus.sparkSession.createDataFrame([], schema))


def vector_search(queries: DataFrame, corpus: DataFrame, k: int = 10, filter_expr: Column | None = None,
                  **kw) -> DataFrame:
    """Top-k corpus rows by cosine to each query vector (exact)."""
    c = corpus if filter_expr is None else corpus.filter(filter_expr)
    return block_topk(c, queries, k, **kw)


#: rows that the lists of the approximate index are fitted on, and lists at most
ANN_SAMPLE_ROWS, ANN_MAX_LISTS = 20_000, 4096
#: rows of the sample, and queries among them, on which the number of lists to open is measured
ANN_TRIAL_ROWS, ANN_TRIAL_QUERIES = 2_000, 200


def _lists_to_open(trial: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Nearest lists that a query opens so that they hold a share of ``recall``
    of the ``k`` best other rows, measured on unit vectors."""
    half = (centres ** 2).sum(1) / 2
    own = np.argmax(trial @ centres.T - half, axis=1)
    q = trial[:ANN_TRIAL_QUERIES]
    near = q @ trial.T
    near[np.arange(len(q)), np.arange(len(q))] = -np.inf
    best = np.argsort(-near, axis=1, kind="stable")[:, :min(k, len(trial) - 1)]
    place = np.argsort(np.argsort(half - q @ centres.T, axis=1, kind="stable"), axis=1)
    opened = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    return int(opened[min(len(opened) - 1, math.ceil(recall * len(opened)))]) + 1 if len(opened) else 1


def ann_search(queries: DataFrame, corpus: DataFrame, k: int = 10, recall: float = 0.95, lists: int | None = None,
               probes: int | None = None, id_col: str = "id", vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "embedding",
               seed: int = 7) -> DataFrame:
    """Approximate neighbours by an inverted file: ``(query_id, id, score, rank)``.

    About sqrt(rows) list centres (``ANN_MAX_LISTS`` at most, or ``lists``) are
    fitted with MLlib KMeans on ``ANN_SAMPLE_ROWS`` rows by hash of the id;
    every row belongs to the list of its nearest centre. A query is compared
    exactly (cosine) with the rows of its nearest lists: as many (or ``probes``)
    as reach ``recall`` on ``ANN_TRIAL_ROWS`` of the sample, and further ones
    until they hold ``k`` rows, so ``k`` rows come back whenever the corpus has
    them. How few lists that is depends on how the vectors cluster; without
    any clusters it is most of them. Lists are assigned inside the scoring
    tasks, so no row is shuffled and a large list is spread over all tasks.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark, schema = corpus.sparkSession, _hit_schema(corpus, id_col, queries, qid_col)
    c = corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    n = lists or min(ANN_MAX_LISTS, math.ceil(math.sqrt(max(1, c.count()))))
    sample = c.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(ANN_SAMPLE_ROWS).select(
        array_to_vector(l2_normalize(F.col("v"))).alias("features")).filter("features IS NOT NULL")
    if sample.isEmpty():
        return _keep_best([], k, spark.createDataFrame([], schema))
    centres = np.array(KMeans(k=max(2, n), seed=seed, maxIter=10).fit(sample).clusterCenters())
    half = (centres ** 2).sum(1) / 2
    if probes is None:
        trial = np.vstack([r["features"].toArray() for r in sample.limit(ANN_TRIAL_ROWS).collect()])
        probes = _lists_to_open(trial, centres, k, recall)
    bc = spark.sparkContext.broadcast((centres, half))

    def slices(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple]:
        cs, h = bc.value
        step = max(1, SCORE_CELLS // max(width, len(cs)))
        for pdf in batches:
            for at in range(0, len(pdf), step):
                m = unit_rows(np.vstack(pdf["v"].iloc[at:at + step].to_numpy()).astype(np.float64))
                yield pdf["id"].to_numpy()[at:at + step], m, np.argmax(m @ cs.T - h, axis=1)

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(bc.value[0]), dtype=np.int64)
        for _, _, near in slices(batches, 1):
            total += np.bincount(near, minlength=len(total))
        some = np.flatnonzero(total)
        yield pd.DataFrame({"list": some, "n": total[some]})

    held = np.zeros(len(centres), dtype=np.int64)
    for r in c.mapInPandas(sizes, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():  # a row per list
        held[r["list"]] = r["n"]
    results = []
    for rows in query_blocks(queries.select(F.col(qid_col).alias("q"), F.col(qvec_col).alias("v")), QUERY_BATCH_ROWS):
        qm = unit_rows(np.asarray([r["v"] for r in rows], dtype=np.float64))
        order = np.argsort(half - qm @ centres.T, axis=1, kind="stable")
        reach = np.cumsum(held[order], axis=1)
        opened = (np.arange(len(centres)) < probes) | (reach - held[order] < k)
        asked = np.zeros((len(centres), len(rows)), dtype=bool)
        asked[order.ravel(), np.repeat(np.arange(len(rows)), len(centres))] = opened.ravel()
        bq = spark.sparkContext.broadcast(([r["q"] for r in rows], qm, [np.flatnonzero(a) for a in asked]))

        def run(batches: Iterator[pd.DataFrame], bq=bq) -> Iterator[pd.DataFrame]:
            qids, q, asking = bq.value
            best = Best(len(qids), k)
            for ids, m, near in slices(batches, len(qids)):
                for x in np.unique(near):
                    if len(asking[x]):
                        own = np.flatnonzero(near == x)
                        best.add(ids[own], np.round(m[own] @ q[asking[x]].T, 9), asking[x])
            yield from best.rows(qids)

        results.append(c.mapInPandas(run, schema))
    return _keep_best(results, k, spark.createDataFrame([], schema))


# --------------------------------------------------------------------------
# cluster, classify
# --------------------------------------------------------------------------


def cluster(df: DataFrame, k: int = 5, seed: int = 1, vec_col: str = "embedding",
            max_iter: int = 20) -> tuple[DataFrame, list[list[float]]]:
    """k groups with MLlib KMeans: rows get ``cluster``; centroids returned."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = df.withColumn("_features", array_to_vector(F.col(vec_col).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster", maxIter=max_iter).fit(feats)
    out = model.transform(feats).drop("_features")
    return out, [c.tolist() for c in model.clusterCenters()]


def centroids(df: DataFrame, label_col: str, vec_col: str = "embedding") -> DataFrame:
    """Mean vector per label: ``posexplode`` then ``avg`` per (label, dim)
    (partial aggregates; no list of rows per label is ever built)."""
    ex = df.select(label_col, F.posexplode(vec_col).alias("dim", "x"))
    g = ex.groupBy(label_col, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # at most ``dims`` entries per label
    return g.groupBy(label_col).agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("_c")).select(
        label_col, F.transform("_c", lambda s: s["m"]).alias("centroid"))


#: components of the label vectors that are broadcast at once
LABEL_CELLS = 1 << 22


def classify(df: DataFrame, label_vectors: DataFrame, label_col: str = "label", vec_col: str = "embedding",
             temperature: float = 0.1) -> DataFrame:
    """Nearest label vector by cosine (ties to the greater label): ``predicted``
    and ``score``; ``scores`` = softmax of cosine / ``temperature`` over the
    labels (ours).

    One matrix product for a slice of rows. Label vectors are broadcast in
    blocks of about ``LABEL_CELLS`` components, one pass over the rows for each;
    any number of them. ``scores`` names every label, so it is given only while
    the labels fit into one block, else it is null.
    """
    labels = label_vectors.select(F.col(label_col).cast("string").alias("l"), F.col("centroid").cast("array<double>").alias("v"))
    width = labels.agg(F.max(F.size("v"))).first()[0]
    if not width:
        raise ValueError("no label vectors")
    blocks = list(query_blocks(labels, max(1, LABEL_CELLS // width)))
    fields = [T.StructField("predicted", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("scores", T.MapType(T.StringType(), T.DoubleType()))]
    base = T.StructType([f for f in df.schema.fields if f.name not in ("predicted", "score", "scores")])
    out = df.select(*[F.col(f"`{f.name}`") for f in base.fields])
    for i, block in enumerate(blocks):
        rows = sorted(((r["l"], r["v"]) for r in block), key=lambda r: r[0], reverse=True)  # the first of equal maxima is the greater label
        sent = df.sparkSession.sparkContext.broadcast(([n for n, _ in rows], unit_rows(np.array([v for _, v in rows], dtype=np.float64))))

        def run(batches: Iterator[pd.DataFrame], sent=sent, first=i == 0, alone=len(blocks) == 1) -> Iterator[pd.DataFrame]:
            names, m = sent.value
            for pdf in batches:
                if first:
                    pdf["predicted"], pdf["score"], pdf["scores"] = None, np.nan, None
                label, score, scores = pdf["predicted"].to_numpy(dtype=object).copy(), pdf["score"].to_numpy(dtype=np.float64).copy(), [None] * len(pdf)
                step = max(1, SCORE_CELLS // len(names))
                for a in range(0, len(pdf), step):
                    x = np.vstack(pdf[vec_col].iloc[a:a + step].to_numpy()).astype(np.float64)
                    cos = np.round(unit_rows(x) @ m.T, 12)  # equal cosines stay equal whatever the order of the sums
                    at = np.argmax(cos, axis=1)
                    best = cos[np.arange(len(at)), at]
                    for j in range(len(at)):
                        name = names[at[j]]
                        if label[a + j] is None or (best[j], name) > (score[a + j], label[a + j]):
                            label[a + j], score[a + j] = name, best[j]
                    if alone:
                        e = np.exp((cos - best[:, None]) / temperature)
                        e /= e.sum(axis=1, keepdims=True)
                        scores[a:a + len(at)] = [dict(zip(names, r.tolist())) for r in e]
                pdf["predicted"], pdf["score"], pdf["scores"] = label, score, scores
                yield pdf

        out = out.mapInPandas(run, T.StructType([*base.fields, *fields]))
    return out


# --------------------------------------------------------------------------
# projection and alignment fits
# --------------------------------------------------------------------------


def project(df: DataFrame, matrix: np.ndarray, vec_col: str = "embedding", out: str = "projected") -> DataFrame:
    """``v @ matrix`` for every row in ``mapInPandas`` (the d x d' matrix is
    a broadcast of fixed size)."""
    mat = np.asarray(matrix, dtype=np.float64)
    bmat = df.sparkSession.sparkContext.broadcast(mat)
    fields = [f for f in df.schema.fields]
    schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = bmat.value
        for pdf in batches:
            if pdf.empty:
                pdf[out] = []
                yield pdf
                continue
            x = np.vstack(pdf[vec_col].to_numpy()).astype(np.float64)
            y = x @ m
            pdf[out] = list(y)
            yield pdf

    return df.mapInPandas(run, schema)


TREE_WIDTH = 8


def gram_sums(pairs: DataFrame, src: str = "source", tgt: str = "target") -> dict:
    """One pass: n, sums of X and Y, XᵀX, XᵀY, YᵀY as partial sums per task
    (``mapInPandas``), merged on the cluster down to ``TREE_WIDTH`` rows and
    added on the driver (d x d sized)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = None
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.vstack(pdf[src].to_numpy()).astype(np.float64)
            y = np.vstack(pdf[tgt].to_numpy()).astype(np.float64)
            part = [len(x), x.sum(0), y.sum(0), x.T @ x, x.T @ y, y.T @ y]
            acc = part if acc is None else [a + b for a, b in zip(acc, part)]
        if acc is not None:
            yield pd.DataFrame({"n": [acc[0]], "sx": [acc[1].tolist()], "sy": [acc[2].tolist()],
                                "xx": [acc[3].ravel().tolist()], "xy": [acc[4].ravel().tolist()],
                                "yy": [acc[5].ravel().tolist()]})

    schema = "n long, sx array<double>, sy array<double>, xx array<double>, xy array<double>, yy array<double>"
    parts = pairs.select(src, tgt).mapInPandas(run, schema)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                vals = [r.n] + [np.asarray(getattr(r, c)) for c in ("sx", "sy", "xx", "xy", "yy")]
                acc = vals if acc is None else [a + b for a, b in zip(acc, vals)]
        if acc is not None:
            yield pd.DataFrame({"n": [acc[0]], "sx": [acc[1].tolist()], "sy": [acc[2].tolist()],
                                "xx": [acc[3].tolist()], "xy": [acc[4].tolist()], "yy": [acc[5].tolist()]})

    # tree reduce on the cluster: one row per task, then at most TREE_WIDTH
    # rows, so the driver receives a bounded number of d x d partial sums
    reduced = parts.repartition(TREE_WIDTH).mapInPandas(merge, schema)
    rows = reduced.collect()
    if not rows:
        raise ValueError("no pairs")
    dx = len(rows[0]["sx"])
    dy = len(rows[0]["sy"])
    tot = {"n": 0, "sx": np.zeros(dx), "sy": np.zeros(dy), "xx": np.zeros((dx, dx)),
           "xy": np.zeros((dx, dy)), "yy": np.zeros((dy, dy))}
    for r in rows:
        tot["n"] += r["n"]
        tot["sx"] += np.asarray(r["sx"])
        tot["sy"] += np.asarray(r["sy"])
        tot["xx"] += np.asarray(r["xx"]).reshape(dx, dx)
        tot["xy"] += np.asarray(r["xy"]).reshape(dx, dy)
        tot["yy"] += np.asarray(r["yy"]).reshape(dy, dy)
    return tot


def fit_ridge(pairs: DataFrame, lam: float = 1e-3, **kw) -> np.ndarray:
    """Linear map W minimising |XW - Y|² + lam |W|² (no intercept)."""
    g = gram_sums(pairs, **kw)
    d = g["xx"].shape[0]
    return np.linalg.solve(g["xx"] + lam * np.eye(d), g["xy"])


def fit_procrustes(pairs: DataFrame, **kw) -> np.ndarray:
    """Orthogonal map from the SVD of XᵀY."""
    g = gram_sums(pairs, **kw)
    u, _, vt = np.linalg.svd(g["xy"], full_matrices=False)
    return u @ vt


def cka(pairs: DataFrame, **kw) -> float:
    """Linear CKA = |XcᵀYc|²_F / (|XcᵀXc|_F |YcᵀYc|_F) from centred Gram sums."""
    g = gram_sums(pairs, **kw)
    n = g["n"]
    mx, my = g["sx"] / n, g["sy"] / n
    xy = g["xy"] - n * np.outer(mx, my)
    xx = g["xx"] - n * np.outer(mx, mx)
    yy = g["yy"] - n * np.outer(my, my)
    den = np.linalg.norm(xx) * np.linalg.norm(yy)
    return float(np.linalg.norm(xy) ** 2 / den) if den > 0 else 0.0


# fixed values (ours): feasibility thresholds
CKA_PROCRUSTES = 0.9
CKA_RIDGE = 0.6
HOLDOUT_SHARE = 0.2


def feasibility(pairs: DataFrame, id_col: str = "id", src: str = "source", tgt: str = "target") -> dict:
    """Recommend ``procrustes`` / ``ridge`` / ``re_embed``: CKA on all pairs,
    maps fitted on a hash-chosen 80% and scored by mean cosine on the rest."""
    h = F.pmod(F.xxhash64(F.col(id_col)), F.lit(100)) < int(HOLDOUT_SHARE * 100)
    train, test = pairs.filter(~h), pairs.filter(h)
    c = cka(pairs, src=src, tgt=tgt)
    scores = {}
    for name, fit in (("ridge", fit_ridge), ("procrustes", fit_procrustes)):
        w = fit(train, src=src, tgt=tgt)
        p = project(test.select(src, tgt), w, vec_col=src, out="_p")
        scores[name] = p.select(F.avg(cosine(F.col("_p"), F.col(tgt)))).first()[0] or 0.0
    method = "procrustes" if c >= CKA_PROCRUSTES else ("ridge" if c >= CKA_RIDGE else "re_embed")
    return {"cka": c, "cosine_ridge": scores["ridge"], "cosine_procrustes": scores["procrustes"],
            "method": method, "samples_advised": int(max(1000, 20 * len(pairs.first()[src])))}


def migrate(src: DataFrame, matrix: np.ndarray, vec_col: str = "embedding") -> DataFrame:
    """Project every vector; rows carry ``projected`` for an upsert."""
    return project(src, matrix, vec_col=vec_col, out="projected")


# --------------------------------------------------------------------------
# recall, drift, quantisation
# --------------------------------------------------------------------------


def recall_at_k(hits: DataFrame, qrels: DataFrame, k: int = 10, query_col: str = "query_id",
                id_col: str = "id") -> DataFrame:
    """Per query: relevant found in the top k / relevant total, and the mean."""
    rel = qrels.select(F.col(qrels.columns[0]).alias(query_col), F.col(qrels.columns[1]).alias(id_col)).distinct()
    tot = rel.groupBy(query_col).agg(F.count(F.lit(1)).alias("relevant"))
    got = hits.filter(F.col("rank") <= k).join(rel, on=[query_col, id_col], how="left_semi") \
        .groupBy(query_col).agg(F.count(F.lit(1)).alias("found"))
    r = tot.join(got, query_col, "left").fillna({"found": 0})
    return r.withColumn("recall", F.round(F.col("found") / F.col("relevant"), 4))


def drift(runs: DataFrame, monitors: DataFrame, now: Column | None = None) -> DataFrame:
    """Per monitor: last recall over the previous one against
    ``min_recovery_r10``; ``due`` when last run + cadence <= now."""
    w = Window.partitionBy("monitor_id").orderBy("ts")
    r = runs.withColumn("_prev", F.lag("recall_at_10").over(w)).withColumn(
        "_rn", F.row_number().over(w.orderBy(F.col("ts").desc())))
    last = r.filter(F.col("_rn") == 1).drop("_rn")
    j = monitors.join(last, "monitor_id", "left")
    now = now if now is not None else F.current_timestamp()
    ratio = F.when(F.col("_prev") > 0, F.col("recall_at_10") / F.col("_prev"))
    return j.withColumn("recovery", ratio).withColumn(
        "alert", F.coalesce(ratio < F.col("min_recovery_r10"), F.lit(False))).withColumn(
        "due", F.coalesce(F.col("ts") + F.make_dt_interval(hours=F.col("cadence_hours")) <= now, F.lit(True))
    ).drop("_prev")


def quantize_sq8(df: DataFrame, vec_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Scalar 8-bit quantisation: per-dimension min/max over the table (a
    ``posexplode`` + grouped min/max), codes 0..255 per element, and the
    reconstruction ``min + code * (max - min) / 255``. The ranges of all
    dimensions are one value, no larger than two vectors, that a scalar subquery
    gives to every row. Any number of dimensions."""
    ex = df.select(F.posexplode(vec_col).alias("dim", "x"))
    rng = ex.groupBy("dim").agg(F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi"))
    one = rng.agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "lo", "hi"))), lambda r: F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"))).alias("_range"))
    code = F.zip_with(F.col(vec_col), F.col("_range"), lambda x, r: F.when(
        r["hi"] > r["lo"], F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.round((x - r["lo"]) / (r["hi"] - r["lo"]) * 255)))
    ).otherwise(F.lit(0.0)).cast("int"))
    q = df.withColumn("_range", one.scalar()).withColumn("codes", F.slice(code, 1, F.greatest(F.size(vec_col), F.lit(0))))
    back = F.zip_with(F.col("codes"), F.slice("_range", 1, F.greatest(F.size(vec_col), F.lit(0))), lambda c, r: r["lo"] + c * (r["hi"] - r["lo"]) / 255.0)
    return q.withColumn("restored", back).drop("_range"), rng
