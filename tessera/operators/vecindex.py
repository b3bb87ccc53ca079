"""A stored inverted file of vectors: approximate top-k by cosine.

``create`` fits list centres on a bounded sample and measures on it how many
of its nearest lists a query has to open for the recall asked for. ``add``
assigns each vector once to the list of its nearest centre and stores it there
with 8-bit codes of its difference from the centre. Lists lie in buckets, so a
search reads the buckets of the lists it opens and no other rows.

A search scores codes first. A code is off by at most half its step in each
component, which bounds the error of a score; only vectors whose score could
still reach the k-th one are then scored exactly. So the codes lose nothing:
what is approximate is the choice of lists alone.

One folder holds versioned tables of the lists and of each vector's list, the
centres, and a manifest that names a version of each, made last.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.vectors import ANN_MAX_LISTS, ANN_SAMPLE_ROWS, ANN_TRIAL_ROWS, QUERY_BATCH_ROWS, SCORE_CELLS, _lists_to_open, l2_normalize, query_blocks, unit_rows
from tessera.session import arrow_slices, cut_lineage, ensure_parallel
from tessera.sources.versioned import Folder, VersionedTable

#: rows of a batch that a task takes as matrices at once
TASK_ROWS = 2048


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix) of the vectors of ``dims`` finite components."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), -1))
    flat = pa.compute.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    first = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    rows = np.flatnonzero(sizes == dims)
    m = flat[first[rows][:, None] + np.arange(dims)] if len(rows) else np.zeros((0, dims))
    good = np.isfinite(m).all(axis=1)
    return rows[good], m[good]


class VectorIndex:
    """``create`` or ``open`` an index, ``add`` and ``remove`` vectors, ``search`` it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, path)
        self.refresh()
        self._lists, self._ids = VersionedTable(spark, f"{self.path}/lists"), VersionedTable(spark, f"{self.path}/ids")
        rows = spark.read.parquet(f"{self.path}/centres").orderBy("list").collect()  # ANN_MAX_LISTS at most
        self.centres = np.array([r["centre"] for r in rows], dtype=np.float64)

    @classmethod
    def create(cls, spark: SparkSession, path: str, sample_of: DataFrame, id_col: str = "id", vec_col: str = "embedding", recall: float = 0.95,
               k: int = 10, lists: int | None = None, buckets: int | None = None, seed: int = 7) -> VectorIndex:
        """An empty index for vectors of the commonest length, with centres fitted
        on ``ANN_SAMPLE_ROWS`` rows of ``sample_of`` by hash of the id. About sqrt(rows) lists, ``ANN_MAX_LISTS``
        at most; the lists that a query opens reach ``recall`` of its ``k`` best
        on ``ANN_TRIAL_ROWS`` of the sample. By default about 8 lists share a bucket."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        path = path.rstrip("/")
        c = sample_of.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
            "v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
        lengths = c.groupBy(F.size("v").alias("dims")).count().orderBy(F.col("count").desc(), "dims").first()
        if lengths is None:
            raise ValueError("no vector to fit list centres on")
        c = c.where(F.size("v") == lengths["dims"])
        n = min(ANN_MAX_LISTS, lists or math.ceil(math.sqrt(lengths["count"])))
        sample = cut_lineage(c.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(ANN_SAMPLE_ROWS).select(array_to_vector(l2_normalize(F.col("v"))).alias("features")))
        centres = np.array(KMeans(k=max(2, n), seed=seed, maxIter=10).fit(sample).clusterCenters())
        trial = np.vstack([r["features"].toArray() for r in sample.limit(ANN_TRIAL_ROWS).collect()])
        probes = _lists_to_open(trial, centres, k, recall)
        spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>").write.parquet(f"{path}/centres")
        id_type = sample_of.schema[id_col].dataType.simpleString()
        buckets = buckets or max(1, n // 8)
        VersionedTable.create(spark, f"{path}/lists", f"list int, id {id_type}, codes binary, step float, vector array<float>", ["list", "id"], buckets, ["list"])
        VersionedTable.create(spark, f"{path}/ids", f"id {id_type}, list int", "id", buckets)
        Folder(spark, path).create("_manifest/000000000000.json", json.dumps(
            {"version": 0, "lists": 0, "ids": 0, "dims": int(centres.shape[1]), "probes": probes, "sizes": {}, "writers": {}}))
        return cls(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        return cls(spark, path)

    def refresh(self) -> None:
        """Takes the newest version; an open index otherwise stays at its own."""
        names = [n for n in self._folder.names("_manifest") if n.endswith(".json") and not n.startswith(".")]
        if not names:
            raise FileNotFoundError(f"no index at {self.path}")
        self.manifest = json.loads(self._folder.read(f"_manifest/{names[-1]}"))

    def _commit(self, parts: dict, writer: tuple[str, int] | None = None) -> None:
        new = self.manifest | parts | {"version": self.manifest["version"] + 1}
        if writer:
            new["writers"] = new["writers"] | {writer[0]: writer[1]}
        self._folder.create(f"_manifest/{new['version']:012d}.json", json.dumps(new))
        self.manifest = new

    # ------------------------------------------------------------- writing

    def _assigned(self, rows: DataFrame) -> DataFrame:
        """(list, id, codes, step, vector) of the usable vectors, each assigned once."""
        sent, id_type = self.spark.sparkContext.broadcast(self.centres), self._ids.schema["id"].dataType
        schema = T.StructType([T.StructField("list", T.IntegerType()), T.StructField("id", id_type), T.StructField("codes", T.BinaryType()),
                               T.StructField("step", T.FloatType()), T.StructField("vector", T.ArrayType(T.FloatType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres = sent.value
            half, dims = (centres ** 2).sum(1) / 2, centres.shape[1]
            step_rows = max(1, SCORE_CELLS // len(centres))
            for batch in arrow_slices(batches, TASK_ROWS):
                rows, m = _matrix(batch.column(1), dims)
                for a in range(0, len(rows), step_rows):
                    x = m[a:a + step_rows].astype(np.float32)
                    unit = unit_rows(x.astype(np.float64))
                    near = np.argmax(unit @ centres.T - half, axis=1)
                    rest = unit - centres[near]
                    step = np.abs(rest).max(axis=1) / 127
                    codes = np.rint(np.divide(rest, step[:, None], out=np.zeros_like(rest), where=step[:, None] > 0)).astype(np.int8)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(near, pa.int32()), batch.column(0).take(pa.array(rows[a:a + step_rows])), pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(step, pa.float32()), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dims, pa.int32()), pa.array(x.ravel()))],
                        [f.name for f in schema])

        return ensure_parallel(rows).mapInArrow(run, schema)

    def add(self, rows: DataFrame, id_col: str = "id", vec_col: str = "embedding", writer: tuple[str, int] | None = None) -> None:
        """Adds vectors, whose ids are unique within ``rows``; one that the
        index holds already is replaced. Vectors that are null, of another
        length than the centres or not finite take no part. A ``writer``
        (name, number) makes a repeated call with the same number do nothing."""
        if writer and self.manifest["writers"].get(writer[0], -1) >= writer[1]:
            return
        id_type = self._ids.schema["id"].dataType
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._assigned(rows.select(F.col(id_col).cast(id_type).alias("id"), F.col(vec_col).alias("v"))).write.parquet(staged)
        new = self.spark.read.parquet(staged)
        parts = self._forget(new.select("id")) if self.manifest["ids"] else {}
        parts["lists"] = self._lists.append(new, base=parts.get("lists", self.manifest["lists"]))["version"]
        parts["ids"] = self._ids.append(new.select("id", "list"), base=parts.get("ids", self.manifest["ids"]))["version"]
        sizes = parts.get("sizes", self.manifest["sizes"])
        for r in new.groupBy("list").count().collect():  # a row per list
            sizes = sizes | {str(r["list"]): sizes.get(str(r["list"]), 0) + r["count"]}
        self._commit(parts | {"sizes": sizes}, writer)
        self._folder.remove(staged.removeprefix(f"{self.path}/"))

    def _forget(self, ids: DataFrame) -> dict:
        old = cut_lineage(self._ids.lookup(ids, self.manifest["ids"]))
        sizes = dict(self.manifest["sizes"])
        for r in old.groupBy("list").count().collect():  # a row per list
            sizes[str(r["list"])] -= r["count"]
        if sizes == self.manifest["sizes"]:
            return {}
        return {"lists": self._lists.delete(old, base=self.manifest["lists"])["version"], "ids": self._ids.delete(old.select("id"), base=self.manifest["ids"])["version"], "sizes": sizes}

    def remove(self, ids: DataFrame, id_col: str = "id") -> None:
        """Removes vectors by id; ids that the index does not hold are ignored."""
        parts = self._forget(ids.select(F.col(id_col).alias("id")))
        if parts:
            self._commit(parts)

    # ------------------------------------------------------------- reading

    def _opened(self, q: np.ndarray, k: int, probes: int | None) -> np.ndarray:
        """(queries x lists) whether a query opens a list: its nearest ones, and further ones until they hold ``k`` rows."""
        held = np.array([self.manifest["sizes"].get(str(i), 0) for i in range(len(self.centres))], dtype=np.int64)
        order = np.argsort((self.centres ** 2).sum(1) / 2 - q @ self.centres.T, axis=1, kind="stable")
        reach = np.cumsum(held[order], axis=1)
        some = (np.arange(len(self.centres)) < (probes or self.manifest["probes"])) | (reach - held[order] < k)
        opened = np.zeros(some.shape, dtype=bool)
        np.put_along_axis(opened, order, some, axis=1)
        return opened & (held > 0)

    def rows_read(self, queries: DataFrame, k: int = 10, qid_col: str = "query_id", qvec_col: str = "embedding", probes: int | None = None) -> DataFrame:
        """``(query_id, lists, rows, share)``: lists and rows that each query opens, and their share of all rows."""
        held = np.array([self.manifest["sizes"].get(str(i), 0) for i in range(len(self.centres))], dtype=np.int64)
        out = []
        for block in query_blocks(queries.select(F.col(qid_col).alias("q"), F.col(qvec_col).alias("v")), QUERY_BATCH_ROWS):
            opened = self._opened(unit_rows(np.array([r["v"] for r in block], dtype=np.float64)), k, probes)
            out += [(r["q"], int(o.sum()), int(held[o].sum()), float(held[o].sum() / max(1, held.sum()))) for r, o in zip(block, opened)]
        schema = T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType), T.StructField("lists", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("share", T.DoubleType())])
        return self.spark.createDataFrame(out, schema)

    def search(self, queries: DataFrame, k: int = 10, qid_col: str = "query_id", qvec_col: str = "embedding", probes: int | None = None) -> DataFrame:
        """``(query_id, id, score, rank)``: the ``k`` best of the lists that each
        query opens (``probes`` nearest ones, else as many as were measured),
        scored exactly; ties by id."""
        id_type = self._ids.schema["id"].dataType
        schema = T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType), T.StructField("id", id_type), T.StructField("score", T.DoubleType())])
        found = self.spark.createDataFrame([], schema)
        usable = queries.select(F.col(qid_col).alias("q"), F.col(qvec_col).alias("v")).where(F.size("v") == self.centres.shape[1])
        for block in query_blocks(usable, QUERY_BATCH_ROWS):
            q = unit_rows(np.array([r["v"] for r in block], dtype=np.float64))
            opened = self._opened(q, k, probes)
            lists = self.spark.createDataFrame([(int(i),) for i in np.flatnonzero(opened.any(axis=0))], "list int")
            # which queries open a list: a bit for each
            sent = self.spark.sparkContext.broadcast(([r["q"] for r in block], q, self.centres, np.packbits(opened.T, axis=1)))
            near = cut_lineage(self._by_codes(self._lists.lookup(lists, self.manifest["lists"]).select("list", "id", "codes", "step"), sent, k, id_type))
            # the k-th score that is certain, over all tasks
            nth = F.row_number().over(Window.partitionBy("q").orderBy(F.col("least").desc()))
            floor = near.withColumn("n", nth).where(F.col("n") == k).select(F.col("q").alias("_q"), F.col("least").alias("floor"))
            near = near.join(F.broadcast(floor), F.col("q") == F.col("_q"), "left").where("floor IS NULL OR most >= floor").select("q", "list", "id")
            exact = self._lists.lookup(lists, self.manifest["lists"]).select("list", "id", "vector")
            found = found.unionByName(self._exactly(exact.join(near.groupBy("list", "id").agg(F.collect_set("q").alias("qs")), ["list", "id"]), sent, schema))
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    @staticmethod
    def _by_codes(rows: DataFrame, sent, k: int, id_type: T.DataType) -> DataFrame:
        """(q, list, id, least, most): rows whose score, known to lie in [least, most], may be among a query's k best."""
        schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("list", T.IntegerType()), T.StructField("id", id_type),
                               T.StructField("least", T.DoubleType()), T.StructField("most", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, q, centres, asking = sent.value
            reach = np.abs(q).sum(1)  # error of a score: half a step in every component
            floor = np.full(len(qids), -np.inf)
            kept: list[tuple] = []  # q, least, most, list, id
            cells = 0

            def prune() -> list[tuple]:
                if not kept:
                    return []
                who, least, most, place = (np.concatenate([x[i] for x in kept]) for i in range(4))
                ids = pa.concat_arrays([x[4] for x in kept])
                order = np.lexsort((-least, who))
                w = who[order]
                at = np.arange(len(w)) - np.searchsorted(w, w) == k - 1
                floor[w[at]] = np.maximum(floor[w[at]], least[order][at])
                keep = np.flatnonzero(most >= floor[who])
                return [(who[keep], least[keep], most[keep], place[keep], ids.take(pa.array(keep)))]

            def leave(part: list[tuple]) -> Iterator[pa.RecordBatch]:
                for who, least, most, place, ids in part:
                    yield pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array(place, pa.int32()), ids, pa.array(least), pa.array(most)], [f.name for f in schema])

            for batch in arrow_slices(batches, TASK_ROWS):
                place = np.asarray(batch.column(0))
                codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.int8).reshape(len(place), -1)
                step = np.asarray(batch.column(3), dtype=np.float64)
                for x in np.unique(place):
                    own, ask = np.flatnonzero(place == x), np.flatnonzero(np.unpackbits(asking[x], count=len(qids)))
                    if not len(ask):
                        continue
                    width = max(1, SCORE_CELLS // len(ask))
                    for a in range(0, len(own), width):
                        rows = own[a:a + width]
                        s = (q[ask] @ centres[x])[None, :] + step[rows][:, None] * (codes[rows].astype(np.float64) @ q[ask].T)
                        slack = (0.5 * step[rows] * 1.001)[:, None] * reach[ask][None, :] + 1e-6
                        r, c = np.nonzero(s + slack >= floor[ask])
                        kept.append((ask[c], (s - slack)[r, c], (s + slack)[r, c], np.full(len(r), x), batch.column(1).take(pa.array(rows[r]))))
                        cells += len(r)
                        if cells > SCORE_CELLS // 4:
                            kept = prune()
                            cells = 0
                            if len(kept[0][0]) > SCORE_CELLS // 4:  # many rows near the k-th: they leave, their floor stays
                                yield from leave(kept)
                                kept = []
            yield from leave(prune())

        return rows.mapInArrow(run, schema)

    @staticmethod
    def _exactly(rows: DataFrame, sent, schema: T.StructType) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            qids, q, _, _ = sent.value
            types = [to_arrow_type(f.dataType) for f in schema]
            for batch in arrow_slices(batches, TASK_ROWS):
                _, m = _matrix(batch.column(2), q.shape[1])
                m, asked = unit_rows(m), batch.column(3)
                n = np.asarray(pa.compute.list_value_length(asked))
                rows, asks = np.repeat(np.arange(len(n)), n), np.asarray(asked.flatten())
                width = max(1, SCORE_CELLS // q.shape[1])
                for a in range(0, len(rows), width):
                    row, who = rows[a:a + width], asks[a:a + width]
                    s = np.round((m[row] * q[who]).sum(1), 9)  # ties are exact and broken by id
                    yield pa.RecordBatch.from_arrays([pa.array([qids[i] for i in who], types[0]), batch.column(1).take(pa.array(row)), pa.array(s)], [f.name for f in schema])

        return rows.select("list", "id", "vector", "qs").mapInArrow(run, schema)
