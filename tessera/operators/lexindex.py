"""A stored lexical index: BM25 top-k without reading the corpus again.

Documents are tokenized once, when they are added. A task sorts a group of
them by collection and length and cuts it into **cells** of ``CELL``
documents; for each term of a cell there is one row with its postings and the
(tf, length) pairs that no other posting of the row beats, from which the
largest score that the term can give within the cell follows exactly. Rows lie
in buckets of their term, so a search reads the lists of its own terms only.
Adding writes new cells and rewrites nothing; documents that come again, or
are removed, are listed as dead.

A search takes queries in blocks of bounded size. One scan of the heads of the
block's terms gives their document frequencies; one scan of their postings,
dealt by cell, scores them. A task keeps the ``k`` best documents of each
query over its cells; a cell whose maxima do not add up to a query's k-th
score so far is not scored for it. A window group limit merges the tasks.

The index is one folder: versioned tables of cells, postings, documents and
the dead, and a manifest that names a version of each, made last.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import count as count_from

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.operators.retrieval import BM25_B, BM25_K1, QUERY_BLOCK, _py_tokens
from tessera.operators.vectors import SCORE_CELLS, Best, query_blocks, word_tokens
from tessera.session import arrow_slices, cut_lineage, ensure_parallel
from tessera.sources.versioned import Folder, VersionedTable

#: documents of a cell (a power of two), and documents or postings that a task sorts at once
CELL, GROUP_DOCS, GROUP_POSTINGS = 512, 16_384, 2_000_000
#: query terms named in the scan's filter; more are joined
IN_LIST = 1000
_LOCAL, _PART = 28, 22  # bits of a document's number within its task, and of the task


def _impact(idf: np.ndarray | float, tf: np.ndarray, dl: np.ndarray, avgdl: float) -> np.ndarray:
    return idf * tf * (BM25_K1 + 1.0) / (tf + BM25_K1 * (1.0 - BM25_B + BM25_B * dl / avgdl))


class LexicalIndex:
    """``create`` or ``open`` an index, ``add`` and ``remove`` documents, ``search`` it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, path)
        self.refresh()
        self._docs, self._postings, self._cells, self._dead = (VersionedTable(spark, f"{self.path}/{n}") for n in ("docs", "postings", "cells", "dead"))

    @classmethod
    def create(cls, spark: SparkSession, path: str, id_type: str = "long", buckets: int = 16) -> LexicalIndex:
        path = path.rstrip("/")
        VersionedTable.create(spark, f"{path}/docs", f"id {id_type}, doc_no long, collection string, dl long", "id", buckets)
        VersionedTable.create(spark, f"{path}/postings", "term string, collection string, cell long, n int, top_tf array<int>, "
                                                         "top_dl array<int>, places array<int>, tfs array<int>, dls array<int>", "term", buckets)
        VersionedTable.create(spark, f"{path}/cells", f"cell long, collection string, n long, dl long, ids array<{id_type}>", "cell", buckets)
        VersionedTable.create(spark, f"{path}/dead", "cell long, doc_no long, collection string, dl long", "cell", buckets)
        Folder(spark, path).create("_manifest/000000000000.json", json.dumps({"version": 0, "docs": 0, "postings": 0, "cells": 0, "dead": 0, "writers": {}}))
        return cls(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LexicalIndex:
        return cls(spark, path)

    def refresh(self) -> None:
        """Takes the newest version; an open index otherwise stays at its own."""
        names = [n for n in self._folder.names("_manifest") if n.endswith(".json") and not n.startswith(".")]
        if not names:
            raise FileNotFoundError(f"no index at {self.path}")
        self.manifest = json.loads(self._folder.read(f"_manifest/{names[-1]}"))

    def _commit(self, parts: dict[str, int], writer: tuple[str, int] | None) -> None:
        new = self.manifest | parts | {"version": self.manifest["version"] + 1}
        if writer:
            new["writers"] = new["writers"] | {writer[0]: writer[1]}
        self._folder.create(f"_manifest/{new['version']:012d}.json", json.dumps(new))
        self.manifest = new

    def _table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}").read(self.manifest[name])

    # ------------------------------------------------------------- writing

    def _staged(self, docs: DataFrame, id_col: str, text: str, collection: Column) -> DataFrame:
        """Cell rows (term null) and posting rows of new documents, stored: texts are tokenized here, once."""
        id_type = self._docs.schema["id"].dataType
        first = self.manifest["version"] + 1
        if first >= 1 << (63 - _LOCAL - _PART):
            raise OverflowError("too many additions: build the index anew")
        cell, group_docs, group_postings = CELL, GROUP_DOCS, GROUP_POSTINGS
        schema = T.StructType([T.StructField("term", T.StringType()), *self._postings.schema.fields[1:], T.StructField("total", T.LongType()),
                               T.StructField("ids", T.ArrayType(id_type))])

        def rows_of(group: list, names: list[str], nos: Iterator[int]) -> Iterator[list]:
            """Rows of one group, cell by cell: documents by collection and length."""
            group.sort(key=lambda g: (g[1] is not None, g[1] or "", g[2]))
            at = 0
            while at < len(group):
                own = group[at:at + cell]
                own = own[:next((i for i, g in enumerate(own) if g[1] != own[0][1]), len(own))]
                no = next(nos)
                dls = [g[2] for g in own]
                rows = [(None, own[0][1], no, len(own), None, None, None, None, dls, sum(dls), [g[0] for g in own])]
                term = np.concatenate([g[3] for g in own])
                order = np.argsort(term, kind="stable")
                term, tfs = term[order], np.concatenate([g[4] for g in own])[order]
                places = np.repeat(np.arange(len(own)), [len(g[3]) for g in own])[order]
                cuts = np.flatnonzero(np.diff(term)) + 1
                for lo, hi in zip([0, *cuts.tolist()] if len(term) else [], [*cuts.tolist(), len(term)]):
                    place, tf = places[lo:hi].tolist(), tfs[lo:hi].tolist()
                    dl = [dls[i] for i in place]
                    top, least = [], None
                    for f, n in sorted(zip(tf, dl), key=lambda p: (-p[0], p[1])):  # a smaller tf counts only with a shorter text
                        if least is None or n < least:
                            top.append((f, n))
                            least = n
                    rows.append((names[term[lo]], own[0][1], no, hi - lo, *[list(x) for x in zip(*top)], place, tf, dl, None, None))
                yield rows
                at += len(own)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            nos = count_from(((first << (_PART + _LOCAL)) | (TaskContext.get().partitionId() << _LOCAL)) // cell)
            target = to_arrow_schema(schema)
            # a document's words are numbers of the group's word list, in arrays
            group, postings, number = [], 0, {}

            def flush() -> Iterator[pa.RecordBatch]:
                for rows in rows_of(group, list(number), nos):
                    for a in range(0, len(rows), 5000):
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows[a:a + 5000]), target)], schema=target)

            for b in arrow_slices(batches):
                for key, name, words in zip(*[c.to_pylist() for c in b.columns]):
                    tokens = _py_tokens(words)
                    counts = Counter(tokens)
                    terms = np.fromiter((number.setdefault(t, len(number)) for t in counts), np.int32, len(counts))
                    group.append((key, name, len(tokens), terms, np.fromiter(counts.values(), np.int32, len(counts))))
                    postings += len(counts)
                    if len(group) >= group_docs or postings >= group_postings:
                        yield from flush()
                        group, postings, number = [], 0, {}
            yield from flush()

        src = docs.select(F.col(id_col).cast(id_type).alias("_id"), collection.cast("string").alias("_collection"), F.col(text).alias("_text"))
        return cut_lineage(ensure_parallel(src).mapInArrow(run, schema))

    def add(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text", collection: str | None = None, writer: tuple[str, int] | None = None) -> None:
        """Adds documents, in the collection that the column ``collection``
        names. Ids are unique within ``docs``; a document that the index holds
        already is replaced. A ``writer`` (name, number) makes a repeated call
        with the same number do nothing."""
        if writer and self.manifest["writers"].get(writer[0], -1) >= writer[1]:
            return
        staged = self._staged(docs, id_col, text, F.col(collection) if collection else F.lit(None).cast("string"))
        cells = staged.where("term IS NULL")
        new = cells.select("cell", "collection", F.posexplode(F.arrays_zip("ids", "dls")).alias("at", "d")).select(
            F.col("d.ids").alias("id"), (F.col("cell") * CELL + F.col("at")).alias("doc_no"), "collection", F.col("d.dls").cast("long").alias("dl"))
        parts = self._bury(new.select("id")) if self.manifest["docs"] else {}
        parts["postings"] = self._postings.append(staged.where("term IS NOT NULL").drop("total", "ids"), base=self.manifest["postings"])["version"]
        parts["cells"] = self._cells.append(cells.select("cell", "collection", F.col("n").cast("long").alias("n"), F.col("total").alias("dl"), "ids"),
                                            base=self.manifest["cells"])["version"]
        parts["docs"] = self._docs.append(new, base=parts.get("docs", self.manifest["docs"]))["version"]
        self._commit(parts, writer)

    def _bury(self, ids: DataFrame) -> dict[str, int]:
        """Lists the documents with these ids as dead and forgets their ids."""
        old = cut_lineage(self._docs.lookup(ids, self.manifest["docs"]))
        if old.isEmpty():
            return {}
        dead = old.select(F.floor(F.col("doc_no") / CELL).alias("cell"), "doc_no", "collection", "dl")
        return {"dead": self._dead.append(dead, base=self.manifest["dead"])["version"], "docs": self._docs.delete(old.select("id"), base=self.manifest["docs"])["version"]}

    def remove(self, ids: DataFrame, id_col: str = "id") -> None:
        """Removes documents by id; ids that the index does not hold are ignored."""
        parts = self._bury(ids.select(F.col(id_col).alias("id")))
        if parts:
            self._commit(parts, None)

    # ------------------------------------------------------------- reading

    def _postings_of(self, terms: list[str]) -> DataFrame:
        """Posting rows of some terms: only their buckets are read, and the terms are in the scan's filter while they are few."""
        t = self.spark.createDataFrame([(x,) for x in terms], "term string")
        if len(terms) > IN_LIST:
            return self._postings.lookup(t, self.manifest["postings"])
        m = self._postings.manifest(self.manifest["postings"])
        buckets = [str(r[0]) for r in t.select(self._postings._bucket_of(m)).distinct().collect()]
        return self._postings._rows(m, buckets).where(F.col("term").isin(terms))

    def search(self, queries: DataFrame, k: int = 10, qid_col: str = "query_id", qtext: str = "text",
               collections: Sequence[str] | DataFrame | None = None, per_collection: bool = False) -> DataFrame:
        """Top-k by BM25, equal to ``bm25_search`` over the same documents:
        ``(query_id, id, score, rank)``, ties by id.

        ``collections`` (names, or a table with them) searches those alone, by
        the figures of their documents alone. With ``per_collection`` every
        collection is searched by its own figures, and the k best of all are
        kept: ``collection`` and ``collection_rank`` are added.
        """
        found, qid = self._blocks(queries, k, qid_col, qtext, collections, per_collection, False)
        hits = found.select(qid.alias("query_id"), "scope", "id", "score")
        order = [F.col("score").desc(), F.col("id").asc()]
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "scope").orderBy(*order))).where(F.col("rank") <= k)
        if not per_collection:
            return hits.drop("scope")
        hits = hits.withColumnsRenamed({"rank": "collection_rank", "scope": "collection"})
        best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "collection", "id"))
        return hits.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "collection", "id", "score", "collection_rank", "rank")

    def read_share(self, queries: DataFrame, k: int = 10, qid_col: str = "query_id", qtext: str = "text",
                   collections: Sequence[str] | DataFrame | None = None, per_collection: bool = False) -> DataFrame:
        """``(query_id, postings, scored)``: postings of each query's terms, and those that its search scores."""
        found, qid = self._blocks(queries, k, qid_col, qtext, collections, per_collection, True)
        return found.groupBy(qid.alias("query_id")).agg(F.sum("id").alias("postings"), F.sum("score").cast("long").alias("scored"))

    def _blocks(self, queries, k, qid_col, qtext, collections, per_collection, count) -> tuple[DataFrame, Column]:
        if isinstance(collections, DataFrame):
            collections = [r[0] for r in collections.select(collections.columns[0]).distinct().collect()]  # a row per collection granted
        inside = F.lit(True) if collections is None else F.col("collection").isin(list(collections)) if collections else F.lit(False)
        scope = F.coalesce(F.col("collection"), F.lit("")) if per_collection else F.lit("")
        asked = queries.select(F.col(qid_col).alias("q"), F.array_distinct(word_tokens(F.col(qtext))).alias("terms"))
        id_type = T.LongType() if count else self._docs.schema["id"].dataType
        schema = T.StructType([T.StructField("q", queries.schema[qid_col].dataType), T.StructField("scope", T.StringType()),
                               T.StructField("id", id_type), T.StructField("score", T.DoubleType())])
        parts = [self._block(rows, k, inside, scope, schema, count) for rows in query_blocks(asked, QUERY_BLOCK)]
        found = self.spark.createDataFrame([], schema)
        for part in parts:
            if part is not None:
                found = found.unionByName(part)
        return found, F.col("q")

    def _figures(self, rows: DataFrame, inside: Column, scope: Column, number: dict[str, int]) -> tuple[dict, DataFrame | None]:
        """By scope: (mean length, idf of each query term); and the dead documents by cell, if any."""
        dead = self._table("dead").where(inside)
        dead = None if self.manifest["dead"] == 0 or dead.isEmpty() else dead
        size = self._table("cells").where(inside).select(scope.alias("scope"), "n", "dl")
        df = rows.groupBy(scope.alias("scope"), "term").agg(F.sum("n").cast("long").alias("df"))
        if dead is not None:
            size = size.unionByName(dead.select(scope.alias("scope"), F.lit(-1).cast("long").alias("n"), (-F.col("dl")).alias("dl")))
            # only cells that hold a dead document are opened, to count it out
            held = rows.join(dead.select("cell").distinct(), "cell", "left_semi").select(
                scope.alias("scope"), "term", "cell", F.explode("places").alias("place")).withColumn("doc_no", F.col("cell") * CELL + F.col("place"))
            lost = held.join(dead.select("doc_no").distinct(), "doc_no", "left_semi").groupBy("scope", "term").agg((-F.count(F.lit(1))).alias("df"))
            df = df.unionByName(lost).groupBy("scope", "term").agg(F.sum("df").alias("df"))
            dead = dead.groupBy("cell").agg(F.collect_set((F.col("doc_no") % CELL).cast("int")).alias("dead"))  # a cell's documents at most
        figures: dict = {}
        for r in size.groupBy("scope").agg(F.sum("n").alias("docs"), F.sum("dl").alias("dl")).collect():  # a row per scope
            if r["docs"] > 0:
                figures[r["scope"]] = (r["docs"], r["dl"] / r["docs"], np.zeros(len(number)))
        for r in df.collect():  # a row per scope and term of the block
            if r["scope"] in figures:
                docs, _, idf = figures[r["scope"]]
                idf[number[r["term"]]] = np.log(1.0 + (docs - r["df"] + 0.5) / (r["df"] + 0.5))
        return {x: (avgdl, idf) for x, (_, avgdl, idf) in figures.items()}, dead

    def _block(self, block: list, k: int, inside: Column, scope: Column, schema: T.StructType, count: bool) -> DataFrame | None:
        terms = sorted({t for r in block for t in (r["terms"] or [])})
        if not terms:
            return None
        number = {t: i for i, t in enumerate(terms)}
        rows = self._postings_of(terms).where(inside)
        figures, dead = self._figures(rows, inside, scope, number)
        if not figures:
            return None
        pairs = np.array([(number[t], j) for j, r in enumerate(block) for t in (r["terms"] or [])], dtype=np.int64)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        first = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
        scopes = sorted(figures)
        sent = self.spark.sparkContext.broadcast((number, [r["q"] for r in block], pairs[:, 1], first, [figures[x] for x in scopes], {x: i for i, x in enumerate(scopes)}))

        lists = ["top_tf", "top_dl", "places", "tfs", "dls"]
        heads = self._table("cells").where(inside)
        heads = heads.withColumn("dead", F.array().cast("array<int>")) if dead is None else heads.join(dead, "cell", "left")
        none = [F.lit(None).cast("array<int>").alias(c) for c in lists]
        dealt = rows.select("cell", scope.alias("scope"), "term", *lists, F.lit(None).cast(heads.schema["ids"].dataType).alias("ids")).unionByName(
            heads.select("cell", scope.alias("scope"), F.lit(None).cast("string").alias("term"), *none[:2], F.col("dead").alias("places"), *none[3:], "ids"))
        dealt = dealt.repartition("cell").sortWithinPartitions("cell", "term")  # a cell's head comes first

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            number, qids, asking, first, figures, at_scope = sent.value
            n_q = len(qids)
            best = Best(n_q * len(figures), k, least=1e-9)
            total, scored = np.zeros(n_q * len(figures), dtype=np.int64), np.zeros(n_q * len(figures), dtype=np.int64)

            def score(head: tuple, held: list) -> None:
                ids, gone, scope_no = head
                avgdl, idf = figures[scope_no]
                t = np.array([h[0] for h in held], dtype=np.int64)
                most = np.array([_impact(idf[h[0]], h[1], h[2], avgdl).max() for h in held])
                n_asking = first[t + 1] - first[t]
                at = np.repeat(first[t] - np.cumsum(n_asking) + n_asking, n_asking) + np.arange(n_asking.sum())
                who, row = asking[at], np.repeat(np.arange(len(t)), n_asking)
                sizes = np.array([len(h[3]) for h in held])
                bound = np.bincount(who, most[row], n_q)
                alive = bound + 1e-8 >= best.floor[scope_no * n_q:(scope_no + 1) * n_q]
                alive &= bound > 0
                own = np.bincount(who, sizes[row], n_q).astype(np.int64)
                total[scope_no * n_q:(scope_no + 1) * n_q] += own
                queries = np.flatnonzero(alive)
                if not len(queries):
                    return
                scored[scope_no * n_q + queries] += own[queries]
                starts = np.cumsum(sizes) - sizes
                place, gain = np.concatenate([h[3] for h in held]), np.concatenate([_impact(idf[h[0]], h[4], h[5], avgdl) for h in held])
                # queries by the additions and scores that they take
                work = np.cumsum(own[queries] + len(ids))
                for some in np.split(queries, np.flatnonzero(np.diff(work // SCORE_CELLS)) + 1):
                    column = np.full(n_q, -1)
                    column[some] = np.arange(len(some))
                    keep = column[who] >= 0
                    asked, r = column[who[keep]], row[keep]
                    # every kept (term, query) takes the term's postings
                    n = sizes[r]
                    p = np.repeat(starts[r] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    s = np.bincount(place[p] * len(some) + np.repeat(asked, n), gain[p], len(ids) * len(some)).reshape(len(ids), len(some))
                    s[gone] = 0.0
                    best.add(ids, np.round(s, 9), scope_no * n_q + some)

            head, held, cell = None, [], None
            for batch in arrow_slices(batches):
                cells, names, words = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
                flat = [(np.asarray(batch.column(3 + i).flatten(), dtype=np.float64 if i in (0, 1, 3, 4) else np.int64),
                         np.concatenate(([0], np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(3 + i)), 0)))))) for i in range(5)]
                for j in range(batch.num_rows):
                    if cells[j] != cell:
                        if held and head is not None:
                            score(head, held)
                        head, held, cell = None, [], cells[j]
                    part = [f[o[j]:o[j + 1]] for f, o in flat]
                    if words[j] is None:
                        if names[j] in at_scope:
                            head = (batch.column(8)[j].values.to_numpy(zero_copy_only=False), part[2], at_scope[names[j]])
                    else:
                        held.append((number[words[j]], *part))
            if held and head is not None:
                score(head, held)
            names = {i: x for x, i in at_scope.items()}
            if count:
                some = np.flatnonzero(total)
                yield pd.DataFrame({"q": [qids[i % n_q] for i in some], "scope": [names[i // n_q] for i in some], "id": total[some], "score": scored[some].astype(float)})
            elif len(best.q):
                yield pd.DataFrame({"q": [qids[i % n_q] for i in best.q], "scope": [names[i // n_q] for i in best.q], "id": best.ids, "score": best.s})

        def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            target = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
            for pdf in run(batches):
                yield pa.RecordBatch.from_pandas(pdf, target, preserve_index=False)

        return dealt.mapInArrow(arrow, schema)
