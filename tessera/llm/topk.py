"""Exact top-k inner products by distributed histogram selection.

Components are quantized to integers, so scores are exact integers and every
re-run agrees. For a block of queries (bounded by its components) each round
scores every candidate, counts the scores in ``BINS`` bins of the interval
that still holds the k-th best score of each query, and narrows the interval
to the bin with the k-th score. A task leaves out only bins below its own
k-th score, which cannot hold the global one. When the k-th value is known, or
only a few rows are left above it, one more pass emits the rows that reach
it, and ties go to the smaller id.

No (query, candidate) pairs are shuffled: per round at most ``k`` bins, at the
end at most ``k`` rows, for each query and task; the tasks are as many as the
cluster has cores, however large the input is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: quantized component = floor(SCALE * x)
SCALE = 1024
#: bins of a query's interval in a round
BINS = 1024
#: components of the queries of one block (4 MB of doubles), and queries at most: a task holds BINS counts for each
QUERY_CELLS, QUERY_ROWS = 1 << 19, 4096
#: scores that a task holds at once
SCORE_CELLS = 1 << 21
#: larger scores are held at this value (and smaller ones at its negative)
SCORE_LIMIT = 1 << 61
_OWN = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max


def _quantized(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer-valued matrix) of the usable vectors, by length.
    Nulls, null components and non-finite ones make a vector unusable."""
    vectors = batch.column(1)
    sizes = pc.list_value_length(vectors)
    known = np.asarray(pc.is_valid(sizes))
    size = np.asarray(pc.fill_null(sizes, 0), dtype=np.int64)
    flat = np.asarray(pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False))
    first = np.cumsum(size) - size
    for n in np.unique(size[known]):
        rows = np.flatnonzero(known & (size == n))
        m = flat[first[rows][:, None] + np.arange(n)] if n else np.zeros((len(rows), 0))
        good = np.isfinite(m).all(axis=1)
        with np.errstate(over="ignore"):
            m = np.clip(np.floor(m[good] * SCALE), -SCORE_LIMIT, SCORE_LIMIT)
        yield rows[good], m


def _products(m: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products (rows x queries), exact: in doubles where no
    partial sum can leave their integers, else in Python's integers."""
    most = lambda a: float(np.abs(a).max(initial=0))
    if most(m) * most(q) * m.shape[1] < 2 ** 53:
        return (m @ q.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in m], dtype=object) @ np.array([[int(x) for x in r] for r in q], dtype=object).T
    return np.clip(whole, -SCORE_LIMIT, SCORE_LIMIT).astype(np.int64)


class _Block:
    """Queries of one block: ids, matrices by length, and each query's interval
    ``[lo, hi)``; ``need`` scores of it are among the k best."""

    def __init__(self, ids: list[int], vectors: list[list[int]], k: int, largest: dict[int, int]):
        self.bins, self.cells = BINS, SCORE_CELLS
        self.ids = np.array(ids, dtype=np.int64)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(v) for v in vectors])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            self.by_length[int(n)] = at, np.array([vectors[i] for i in at], dtype=np.float64).reshape(len(at), int(n))
        # |score| <= sum of |query components| * largest |candidate component|
        reach = [min(SCORE_LIMIT, sum(map(abs, v)) * largest.get(len(v), 0)) for v in vectors]
        self.lo = np.array([-r for r in reach], dtype=np.int64)
        self.hi = np.array([r + 1 for r in reach], dtype=np.int64)
        self.need = np.full(len(ids), k, dtype=np.int64)
        self.open = np.full(len(ids), True)

    def width(self) -> np.ndarray:
        return np.maximum(1, -((self.lo - self.hi) // self.bins))


def _scores(batches: Iterator[pa.RecordBatch], block: _Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(candidate ids, numbers of the queries, scores) of every candidate."""
    for batch in batches:
        ids = np.asarray(pc.fill_null(batch.column(0), _NO_ID), dtype=np.int64)
        for rows, m in _quantized(batch):
            if m.shape[1] not in block.by_length:
                continue
            queries, q = block.by_length[m.shape[1]]
            step = max(1, block.cells // len(queries))
            for a in range(0, len(rows), step):
                own_ids = ids[rows[a:a + step]]
                s = _products(m[a:a + step], q)
                s[own_ids[:, None] == block.ids[queries][None, :]] = _OWN
                yield own_ids, queries, s


def _histograms(candidates: DataFrame, block: _Block) -> list:
    """For each open query the bin of its k-th score: (q, bin, n in it, cum from the top)."""
    sent = candidates.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        width, counts = b.width(), np.zeros((len(b.ids), b.bins), dtype=np.int64)
        for _, queries, s in _scores(batches, b):
            lo, hi = b.lo[queries], b.hi[queries]
            row, col = np.nonzero((s >= lo) & (s < hi) & b.open[queries] & (s != _OWN))
            place = (s[row, col] - lo[col]) // width[queries[col]]
            counts += np.bincount(queries[col] * b.bins + place, minlength=counts.size).reshape(counts.shape)
        top = counts[:, ::-1]
        before = np.cumsum(top, axis=1) - top
        q, at = np.nonzero((top > 0) & (before < b.need[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(b.bins - 1 - at, pa.int32()), pa.array(top[q, at], pa.int64()),
                                          pa.array(b.need[q], pa.int64())], ["q", "bin", "n", "need"])

    bins = candidates.mapInArrow(run, "q int, bin int, n long, need long").groupBy("q", "bin").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
    cum = F.sum("n").over(Window.partitionBy("q").orderBy(F.col("bin").desc()))
    found = bins.withColumn("cum", cum).where("cum >= need").groupBy("q").agg(F.max_by(F.struct("bin", "n", "cum"), "bin").alias("b"))
    rows = found.select("q", "b.*").collect()  # a row per query of the block
    sent.destroy()
    return rows


def _survivors(candidates: DataFrame, block: _Block, k: int) -> DataFrame:
    """Candidates that reach the k-th score of a query, at most k per query and task."""
    sent = candidates.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        kept = [np.empty(0, dtype=np.int64)] * 3  # query, score, id

        def best() -> list[np.ndarray]:
            q, s, i = kept
            order = np.lexsort((i, -s, q))
            q = q[order]
            first = np.arange(len(q)) - np.searchsorted(q, q) < k
            return [q[first], s[order][first], i[order][first]]

        for ids, queries, s in _scores(batches, b):
            row, col = np.nonzero((s >= b.lo[queries]) & (s != _OWN))
            kept = [np.concatenate(x) for x in zip(kept, (queries[col], s[row, col], ids[row]))]
            if len(kept[0]) > b.cells:
                kept = best()
        q, s, i = best()
        yield pa.RecordBatch.from_arrays([pa.array(b.ids[q], pa.int64()), pa.array(i, pa.int64(), mask=i == _NO_ID), pa.array(s, pa.int64())],
                                         ["query_id", "vec_id", "score"])

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def _by_hash(df: DataFrame, column: str, blocks: int, i: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(column), F.lit(blocks)) == i)


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best candidates of every query: ``(query_id, rank, vec_id, score)``.

    Both tables have integer ids and vectors of numbers; the score is the inner
    product of the quantized vectors. Rows with the query's own id are no
    candidates; equal scores go by ascending id, null ids last. Vectors that are
    null or hold a null or non-finite component take no part, neither do those
    of another length than the query's. Every repeated row of the candidates
    counts; queries that share an id ask once, with the first vector in array
    order; a null id is no query. Fewer than ``k`` candidates come back whole,
    without any there is no row. Other columns are ignored. Scores beyond
    +-2^61 are held there.

    A query block of bounded size is collected and broadcast at a time; each of
    its rounds (3 for ordinary vectors) is one pass over the candidates, in as
    many tasks as the session has cores.
    """
    spark = candidates.sparkSession
    c = candidates.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    tasks = spark.sparkContext.defaultParallelism
    c = c.coalesce(tasks) if c.rdd.getNumPartitions() >= tasks else c.repartition(tasks)

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, m in _quantized(batch):
                flat = pa.array(m.ravel().astype(np.int64))
                offsets = pa.array(np.arange(len(rows) + 1) * m.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)).cast(pa.int64()), pa.ListArray.from_arrays(offsets, flat)], ["id", "v"])

    def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        largest: dict[int, int] = {}
        for batch in batches:
            for _, m in _quantized(batch):
                largest[m.shape[1]] = max(largest.get(m.shape[1], 0), int(np.abs(m).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array(list(largest), pa.int64()), pa.array(list(largest.values()), pa.int64())], ["n", "most"])

    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("id IS NOT NULL")
    asked = cut_lineage(asked.mapInArrow(integers, "id long, v array<long>").groupBy("id").agg(F.min("v").alias("v")))
    size = asked.agg(F.count("id").alias("rows"), F.coalesce(F.sum(F.size("v").cast("long")), F.lit(0)).alias("cells")).first()
    blocks = max(math.ceil(size["rows"] / QUERY_ROWS), math.ceil(size["cells"] / QUERY_CELLS))
    lengths = asked.select(F.size("v").cast("long").alias("n")).distinct()
    extent = c.mapInArrow(extents, "n long, most long").join(lengths, "n", "left_semi").groupBy("n").agg(F.max("most").alias("most"))
    largest = {r["n"]: r["most"] for r in extent.collect()} if blocks else {}  # a row per length of a query vector
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for i in range(blocks):
        rows = _by_hash(asked, "id", blocks, i).collect()  # about QUERY_ROWS rows and QUERY_CELLS components
        if not rows:
            continue
        block = _Block([r["id"] for r in rows], [list(r["v"]) for r in rows], k, largest)
        while block.open.any():
            width, still = block.width(), np.full(len(rows), False)
            for r in _histograms(c, block):
                q = r["q"]
                block.need[q] -= r["cum"] - r["n"]
                block.lo[q] += r["bin"] * width[q]
                block.hi[q] = min(block.hi[q], block.lo[q] + width[q])
                # few rows reach the bin: the final order settles them
                still[q] = block.hi[q] - block.lo[q] > 1 and k - block.need[q] + r["n"] > 2 * k
            block.open = still  # a query without a k-th score takes all of its interval
        best = _survivors(c, block, k)
        found = found.unionByName(best if blocks == 1 else cut_lineage(best))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
