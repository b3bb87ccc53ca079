"""Ranked lexical search by Block-Max MaxScore over stored shards.

Every document is tokenized once into a shard of at most ``SHARD_DOCS``
documents or ``SHARD_POSTINGS`` postings of the queries' terms, numbered by ascending
doc_id: for each term its postings in blocks of ``BLOCK``, packed into the
least byte widths, and for each block its last document and the (tf, length)
pairs that no other posting of the block beats. Shards are written to the
checkpoint folder; their document frequencies, counts and lengths are added up
into the figures of the whole corpus, from which weights and block maxima
follow exactly.

A search goes through a shard window by window of documents. The
lists whose global bounds together stay within the k-th score so far are
non-essential: only documents of the other lists are candidates. A candidate
is dropped as soon as its score, the block maximum of the next non-essential
list and the global bounds of those left cannot beat the k-th score; blocks
without a surviving candidate are never unpacked. Later documents have larger
ids, so equal scores lose. The heaps of the shards are merged by a window
group limit.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage, ensure_parallel

#: documents and postings of a shard, postings of a block, documents of the first and of later windows
SHARD_DOCS, SHARD_POSTINGS, BLOCK, FIRST_WINDOW, WINDOW = 32_768, 3_000_000, 128, 256, 4096
#: bytes of the terms of one block of queries (its vocabulary is broadcast), and queries at most
VOCABULARY_BYTES, QUERY_ROWS = 16 << 20, 4096
#: texts are cut into pieces of about so many bytes, between words
PIECE = 4 << 20

#: A-Z in lower case, everything that is neither ASCII letter, digit nor beyond ASCII a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Terms of a UTF-8 text with their counts."""
    folded = text.translate(_FOLD)
    counts: Counter = Counter()
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE) if at + PIECE < len(folded) else -1
        end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers in the least of 1, 2, 4 or 8 bytes each, that width first."""
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << (8 * w - (w == 8)))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width = data[at]
    return np.frombuffer(data, f"<u{width}", n, at + 1).astype(np.int64), at + 1 + width * n


class Postings:
    """One term's list in a shard, as stored: block ends, frontiers, packed blocks."""

    def __init__(self, last: list[int], sizes: list[int], frontier: list[int], tf: list[int], length: list[int], starts: list[int], data: bytes):
        self.last, self.sizes = np.array(last, dtype=np.int64), np.array(sizes, dtype=np.int64)
        self.frontier, self.tf, self.length = np.array(frontier, dtype=np.int64), np.array(tf, dtype=np.int64), np.array(length, dtype=np.int64)
        self.starts, self.data = starts, data

    @staticmethod
    def pack(docs: np.ndarray, tf: np.ndarray, length: np.ndarray, block: int = BLOCK) -> tuple:
        """Fields of the constructor for postings in document order."""
        last, sizes, frontier, ftf, flen, starts, parts, at = [], [], [], [], [], [], [], 0
        for a in range(0, len(docs), block):
            d, t, n = docs[a:a + block], tf[a:a + block], length[a:a + block]
            order = np.lexsort((n, -t))
            best = order[np.concatenate(([True], n[order][1:] < np.minimum.accumulate(n[order])[:-1]))]  # a smaller tf only with a shorter text
            frontier.append(len(ftf))
            ftf += t[best].tolist()
            flen += n[best].tolist()
            part = _packed(np.diff(d, prepend=0)) + _packed(t)
            last.append(int(d[-1]))
            sizes.append(len(d))
            starts.append(at)
            parts.append(part)
            at += len(part)
        return last, sizes, frontier, ftf, flen, starts, b"".join(parts)

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, tf) of a block, unpacked."""
        n = int(self.sizes[i])
        gaps, at = _unpacked(self.data, self.starts[i], n)
        return np.cumsum(gaps), _unpacked(self.data, at, n)[0]


class Figures:
    """Counts of the whole corpus and the scoring rule."""

    def __init__(self, n_docs: int, total: int, df: dict[int, int]):
        self.n_docs, self.total = n_docs, total
        # fixed rule: floor(1000 ln((2N + 2) / (2 df + 1)))
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}

    def damping(self, length: np.ndarray) -> np.ndarray:
        """8 m of texts of so many terms; 90 n N in Python's integers where it would leave 64 bits."""
        if 90 * int(length.max(initial=0)) * self.n_docs < 1 << 62:
            return 8 * (10 + 90 * length * self.n_docs // max(1, self.total))
        return np.array([8 * (10 + 90 * int(n) * self.n_docs // self.total) for n in length], dtype=np.int64)

    @staticmethod
    def impact(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + damping)


class Shard:
    """Search over one shard: ``lengths`` of its documents and the postings of each term."""

    def __init__(self, lengths: np.ndarray, postings: dict[int, Postings], figures: Figures):
        self.n, self.damping, self.postings, self.figures = len(lengths), figures.damping(lengths), postings, figures
        self.opened: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # unpacked blocks: documents, weighted scores
        self.block_max: dict[int, np.ndarray] = {}  # weighted, by block
        for t, p in postings.items():
            self.block_max[t] = figures.weight[t] * np.maximum.reduceat(figures.impact(p.tf, figures.damping(p.length)), p.frontier)

    def _blocks(self, t: int, numbers: Iterable[int]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, weighted scores) of some blocks of a term, in order; a block is unpacked when first asked for."""
        parts = []
        for b in numbers:
            if (t, b) not in self.opened:
                docs, tf = self.postings[t].block(b)
                self.opened[t, b] = docs, self.figures.weight[t] * self.figures.impact(tf, self.damping[docs])
            parts.append(self.opened[t, b])
        return (np.concatenate([d for d, _ in parts]), np.concatenate([s for _, s in parts])) if parts else (np.empty(0, dtype=np.int64),) * 2

    def _add(self, t: int, docs: np.ndarray, score: np.ndarray, blocks: np.ndarray) -> None:
        """Adds the term's scores to the (ascending) documents, whose blocks are given."""
        held, gain = self._blocks(t, np.unique(blocks).tolist())
        if len(held):
            at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
            score += np.where(held[at] == docs, gain[at], 0)

    def _candidates(self, t: int, lo: int, hi: int) -> np.ndarray:
        """The term's documents in [lo, hi)."""
        p = self.postings[t]
        first = int(np.searchsorted(p.last, lo))
        docs = self._blocks(t, range(first, min(len(p.last), int(np.searchsorted(p.last, hi - 1)) + 1)))[0]
        return docs[np.searchsorted(docs, lo):np.searchsorted(docs, hi)]

    def search(self, terms: list[int], k: int, first: int = FIRST_WINDOW, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best with a score above 0, best first, ties to the smaller number."""
        terms = [t for t in terms if t in self.postings and self.figures.weight[t] > 0]
        terms.sort(key=lambda t: (int(self.block_max[t].max()), t))
        bounds = np.cumsum([0] + [int(self.block_max[t].max()) for t in terms])  # of the first so many lists together
        best_docs, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        hi, width = 0, first
        while hi < self.n:
            lo, hi, width = hi, min(self.n, hi + width), min(window, 2 * width)
            kth = int(best[-1]) if len(best) == k else 0  # a newcomer has to exceed it
            essential = int(np.searchsorted(bounds[1:], kth, side="right"))  # lists before it together cannot exceed it
            if essential == len(terms):
                break
            docs = np.unique(np.concatenate([self._candidates(t, lo, hi) for t in terms[essential:]]))
            if not len(docs):
                continue
            score = np.zeros(len(docs), dtype=np.int64)
            for j in range(len(terms) - 1, -1, -1):
                t = terms[j]
                p = self.postings[t]
                blocks = np.searchsorted(p.last, docs)
                inside = blocks < len(p.last)
                if j < essential and kth:
                    most = np.where(inside, self.block_max[t][np.minimum(blocks, len(p.last) - 1)], 0)
                    alive = score + most + bounds[j] > kth
                    docs, score, blocks, inside = docs[alive], score[alive], blocks[alive], inside[alive]
                    if not len(docs):
                        break
                n = int(np.searchsorted(~inside, True))  # documents behind the list's last one have no block
                self._add(t, docs[:n], score[:n], blocks[:n])
            if not len(docs):
                continue
            new = score > kth
            docs, score = docs[new], score[new]
            if len(docs):
                all_docs, all_scores = np.concatenate((best_docs, docs)), np.concatenate((best, score))
                order = np.lexsort((all_docs, -all_scores))[:k]
                best_docs, best = all_docs[order], all_scores[order]
        return best_docs, best


_SHARD = [T.StructField("term", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType()),
          T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("last", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
          T.StructField("frontier", T.ArrayType(T.LongType())), T.StructField("tf", T.ArrayType(T.LongType())), T.StructField("flen", T.ArrayType(T.LongType())),
          T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType())]


def build_shards(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards of a corpus over the given terms: for each a head (term null) with
    its document ids, lengths, ``n`` documents that have a term and the
    ``total`` of all terms, then a row for each term with its postings."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([*_SHARD, T.StructField("ids", T.ArrayType(T.LongType()))])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        known, size, types = sent.value, BLOCK, [to_arrow_type(f.dataType) for f in schema]
        wanted = known.keys()
        ids: list = []
        lengths, term, doc, count, total = array("q"), array("q"), array("q"), array("q"), 0

        def flush() -> Iterator[pa.RecordBatch]:
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            place = np.empty(len(ids), dtype=np.int64)
            place[order] = np.arange(len(ids))
            length = np.array(lengths, dtype=np.int64)[order]
            head = [None, int((length > 0).sum()), total, length.tolist(), None, None, None, None, None, None, None, [ids[i] for i in order]]
            t, d, c = np.array(term, dtype=np.int64), place[np.array(doc, dtype=np.int64)], np.array(count, dtype=np.int64)
            by = np.lexsort((d, t))
            t, d, c = t[by], d[by], c[by]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(t)) + 1, [len(t)])) if len(t) else np.zeros(1, dtype=np.int64)
            rows = [head]
            for a, z in zip(cuts[:-1], cuts[1:]):
                rows.append([int(t[a]), int(z - a), None, None, *Postings.pack(d[a:z], c[a:z], length[d[a:z]], size), None])
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), types)], names)

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i, key in enumerate(pc.cast(batch.column(0), pa.int64()).to_pylist()):
                counts = term_counts(texts[i].as_py() or b"")
                n = sum(counts.values())
                if not n:
                    continue  # a document without terms counts nowhere
                for x in counts.keys() & wanted:
                    term.append(known[x])
                    doc.append(len(ids))
                    count.append(counts[x])
                ids.append(key)
                lengths.append(n)
                total += n
                if len(ids) == SHARD_DOCS or len(term) >= SHARD_POSTINGS:
                    yield from flush()
                    ids, lengths, term, doc, count, total = [], array("q"), array("q"), array("q"), array("q"), 0
        if ids:
            yield from flush()

    return ensure_parallel(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text"))).mapInArrow(run, schema)


def search_shards(shards: DataFrame, figures: Figures, asked: list[tuple[int, list[int]]], k: int) -> DataFrame:
    """The k best documents of every shard for every query: ``(q, id, score)``;
    ``q`` numbers the queries. A shard's rows lie together, so a task holds one shard at a time."""
    sent, windows = shards.sparkSession.sparkContext.broadcast((figures, asked)), (FIRST_WINDOW, WINDOW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, queries = sent.value
        head, postings = None, {}

        def answers() -> pa.RecordBatch:
            shard = Shard(np.array(head["lengths"], dtype=np.int64), postings, rule)
            ids = pa.array(head["ids"], pa.int64())
            q, docs, scores = [], [], []
            for j, terms in queries:
                d, s = shard.search(terms, k, *windows)
                q += [j] * len(d)
                docs.append(d)
                scores.append(s)
            docs = np.concatenate(docs) if docs else np.empty(0, dtype=np.int64)
            scores = np.concatenate(scores) if scores else np.empty(0, dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), ids.take(pa.array(docs)), pa.array(scores, pa.int64())], ["q", "id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["term"] is None:
                    if head is not None:
                        yield answers()
                    head, postings = row, {}
                else:
                    postings[row["term"]] = Postings(row["last"], row["sizes"], row["frontier"], row["tf"], row["flen"], row["starts"], row["data"])
        if head is not None:
            yield answers()

    return shards.mapInArrow(run, "q int, id long, score long")


def _query_terms(queries: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, terms)``: rows that share an id are one query with all of their terms."""
    schema = T.StructType([T.StructField("id", queries.schema[id_col].dataType), T.StructField("term", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                terms = list(term_counts(texts[i].as_py() or b""))
                if terms:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(terms))), pa.array(terms, pa.binary())], ["id", "term"])

    found = queries.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)
    return cut_lineage(found.groupBy("id").agg(F.collect_set("term").alias("terms")))


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text",
                   qid_col: str = "item_id", qtext: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of every query: ``(qid_col, rank, id_col, score)``.

    Terms are runs of ASCII letters and digits and of anything beyond ASCII,
    with A-Z lower-cased; null and empty texts have none. Every row is a
    document, repeated ones too; ids are integers, equal scores go by ascending
    id, null ids last. Rows of ``queries`` that share an id (or have none) are
    one query with all of their terms; a query without terms, or without a
    document that scores above 0, has no rows. Other columns are ignored.

    Queries go in blocks whose vocabulary is bounded; a block tokenizes the
    corpus once into stored shards and searches them once.
    """
    spark = docs.sparkSession
    asked = _query_terms(queries, qid_col, qtext)
    size = asked.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 64)), F.lit(0)).alias("bytes")).first()
    blocks = max(math.ceil(size["rows"] / QUERY_ROWS), math.ceil(size["bytes"] / VOCABULARY_BYTES))
    schema = T.StructType([T.StructField("qid", asked.schema["id"].dataType), T.StructField("id", T.LongType()), T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], schema)
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).collect()  # about QUERY_ROWS rows and VOCABULARY_BYTES
        if not rows:
            continue
        vocabulary = {t: n for n, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        shards = cut_lineage(build_shards(docs, vocabulary, id_col, text))
        sums = shards.groupBy("term").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # a row per term of the block
        whole = next((r for r in sums if r["term"] is None), None)
        if whole is None:
            continue
        figures = Figures(whole["n"], whole["total"], {r["term"]: r["n"] for r in sums if r["term"] is not None})
        queries_of = [(j, [vocabulary[bytes(t)] for t in r["terms"]]) for j, r in enumerate(rows)]
        best = search_shards(shards, figures, queries_of, k)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(j, r["id"]) for j, r in enumerate(rows)], T.StructType([T.StructField("q", T.IntegerType()), T.StructField("qid", schema["qid"].dataType)]))
        part = best.join(F.broadcast(names), "q").select("qid", "id", "score")
        found = found.unionByName(part if blocks == 1 else cut_lineage(part))
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.select(F.col("qid").alias(qid_col), "rank", F.col("id").alias(id_col), "score")
