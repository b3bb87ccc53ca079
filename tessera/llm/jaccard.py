"""N-gram Jaccard join: MinHash banding, then exact verification.

Texts are sets of hashed 5-word shingles over folded words. Band and row
counts are chosen for a target recall at the wanted similarity. Bands are
shuffled on their hashes; texts that share a band belong to one candidate
component. Inside a component every pair whose set sizes allow the similarity
is compared on the full sets, blockwise: what leaves a block are counts and
spanning links per text, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.llm.text import U, map_texts, mix, word_hashes_of
from tessera.session import cut_lineage

NGRAM = 5
SIMILARITY = 0.8
#: share of the pairs at exactly SIMILARITY that share a band, at least
TARGET_RECALL = 0.9995
MAX_HASHES = 128
#: texts and shingles of one block, on average
BLOCK_TEXTS = 400
BLOCK_SHINGLES = 400_000
#: shingle columns of one matrix product
COLUMNS = 8192


def choose_bands(similarity: float = SIMILARITY, recall: float = TARGET_RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the most rows, so the fewest false candidates, whose
    chance to miss a pair at ``similarity`` is ``1 - recall`` at most within
    ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = similarity ** rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("the target recall needs more hashes")
    return best


def shingle_hashes(words: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """Hashes of all n-word windows; a text of fewer words is one window."""
    if not len(words):
        return words
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for j in range(size):
        out = mix(out + words[j: len(words) - size + 1 + j] * U(2 * j + 3))
    return out


def _signatures(bands: int, rows: int, n: int):
    """Function from texts to their class keys and band hashes."""
    random = np.random.default_rng(20240601)
    factors = random.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | U(1)
    shifts = random.integers(1, 1 << 63, bands, dtype=np.uint64)

    def signatures(texts: list[str]) -> dict[str, list]:
        words, at = word_hashes_of(texts)
        keys, out = [], []
        for i, text in enumerate(texts):
            w = words[at[i]:at[i + 1]]
            keys.append(class_key(w, text))
            s = shingle_hashes(w, n)
            if not len(s):
                out.append([])
                continue
            least = np.fromiter(((s * f).min() for f in factors), dtype=np.uint64, count=len(factors)) if len(s) > 2000 \
                else (s[:, None] * factors).min(axis=0)
            b = shifts.copy()
            for r in range(rows):
                b = mix(b ^ least[r::rows])
            out.append(b.view(np.int64))
        return {"cls": keys, "bands": out}

    return signatures


def class_key(words: np.ndarray, text: str) -> bytes:
    """16 bytes that are equal for texts of equal folded words; texts without
    words are compared by their characters."""
    if not len(words):
        import hashlib

        return b"\0" * 8 + hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    place = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    both = np.array([mix(words ^ place).sum(dtype=np.uint64), (words * (place | U(1))).sum(dtype=np.uint64)], dtype=np.uint64)
    return both.tobytes()


def jaccard_classes(docs: DataFrame, n: int = NGRAM, similarity: float = SIMILARITY, recall: float = TARGET_RECALL,
                    max_hashes: int = MAX_HASHES) -> DataFrame:
    """One row per document: ``doc_id, class_id, copy_of, n_links``.

    Documents are linked when the Jaccard similarity of their shingle sets is
    ``similarity`` or more. ``class_id`` is the smallest doc_id that a chain of
    links leads to, ``copy_of`` the smallest doc_id with the same words, and
    ``n_links`` the number of other documents that it is linked to, copies
    included. Pairs of different texts are found by banding with a recall of
    ``recall`` at the least similarity, more above it.

    Reads ``doc_id, text``; other columns are ignored. Null texts count as
    empty. Texts without words are linked only to texts of equal characters. A
    text shorter than ``n`` words is one shingle. Repeated rows are copies of
    each other; rows with a null doc_id are treated like others, and their
    class_id is null only if the whole class has no doc_id. An empty table
    gives no rows.
    """
    bands, rows = choose_bands(similarity, recall, max_hashes)
    docs = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    sig = cut_lineage(map_texts(docs, _signatures(bands, rows, n), ["doc_id", "th"], "text", "cls binary, bands array<long>"))
    # a class is all texts with the same words
    classes = sig.groupBy("cls").agg(F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("n"),
                                     F.min(F.struct("doc_id", "th", "bands")).alias("r"))
    classes = cut_lineage(classes.select("cls", "copy_of", "n", F.struct("r.doc_id", "r.th").alias("first"), F.col("r.bands").alias("bands")))
    # nodes of the candidate graph are 8 bytes of the class key: a collision would only widen a component
    node = F.xxhash64("cls")
    banded = classes.select(node.alias("k"), F.explode("bands").alias("h"))
    shared = banded.groupBy("h").agg(F.min("k").alias("head"), F.max("k").alias("last")).where("head <> last").select("h", "head")
    components = connected_components(banded.join(shared, "h").select("k", "head"))
    roots = components.select("root").distinct().withColumn("node", F.col("root"))
    members = components.unionByName(roots)
    near = classes.select("cls", "first", "n", node.alias("node")).join(members, "node").drop("node")
    near = cut_lineage(near)  # candidates only
    links = cut_lineage(verify(near, docs, n, similarity))
    degrees = links.groupBy("cls").agg(F.sum("linked").alias("linked"))
    merged = connected_components(links.where("cls <> head").select("cls", "head")).select(F.col("node").alias("cls"), F.col("root"))
    full = classes.select("cls", "copy_of", "n").join(degrees, "cls", "left").join(merged, "cls", "left")
    full = full.withColumn("root", F.coalesce("root", "cls"))
    ids = full.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    full = full.join(ids, "root").select("cls", "copy_of", "class_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    return sig.select("doc_id", "cls").join(full, "cls").select("doc_id", "class_id", "copy_of", "n_links")


def verify(near: DataFrame, docs: DataFrame, n: int, similarity: float) -> DataFrame:
    """``cls, linked, head`` rows: documents of other texts linked to ``cls``
    in one block, and a class of the block that it is chained to.

    ``near`` has ``cls, first, n, root`` of the candidates, ``first`` with the
    doc_id and the hash of the text of one row of the class; ``docs`` has
    ``doc_id, th, text``. Sets can
    only be similar if one size is at least ``similarity`` of the other, so
    sizes are cut into levels of that ratio, and only equal and adjacent
    levels of a component meet. A level with many texts is cut into blocks by
    hash, and each pair of blocks is compared in one place.
    """
    ids = near.select(F.col("first.doc_id").alias("_id"), F.col("first.th").alias("_th"), F.col("cls").alias("_cls"))
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    sets = map_texts(texts, _window_sets(n), ["_cls"], "text", "cls binary, windows binary, n_distinct int")
    # repeated rows come along; equal texts give equal sets
    sets = sets.where("_cls = cls").select("cls", "windows", "n_distinct").dropDuplicates(["cls"])
    level = F.floor(F.log(F.col("n_distinct").cast("double")) / F.lit(-math.log(similarity))).cast("int")
    sets = cut_lineage(sets.join(near.select("cls", "n", "root"), "cls").withColumn("level", level))
    parts = sets.groupBy("root", "level").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_distinct") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    above = parts.select("root", (F.col("level") - 1).alias("level"), F.col("parts").alias("above"))
    below = parts.select("root", (F.col("level") + 1).alias("level"), F.col("parts").alias("below"))
    parts = parts.join(above, ["root", "level"], "left").join(below, ["root", "level"], "left").na.fill(0, ["above", "below"])
    s = sets.join(parts, ["root", "level"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    # block pairs are named by (lower level, part there, other level, part there)
    here = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
        F.col("level").alias("a"), F.least("part", p).alias("pa"), F.col("level").alias("b"), F.greatest("part", p).alias("pb")))
    pairs = lambda count, make: F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)).otherwise(
        F.array().cast("array<struct<a:int,pa:int,b:int,pb:int>>"))
    up = pairs("above", lambda p: F.struct(F.col("level").alias("a"), F.col("part").alias("pa"), (F.col("level") + 1).alias("b"), p.alias("pb")))
    down = pairs("below", lambda p: F.struct((F.col("level") - 1).alias("a"), p.alias("pa"), F.col("level").alias("b"), F.col("part").alias("pb")))
    met = s.select("root", "cls", "n", "windows", "level", "part", F.explode(F.concat(here, up, down)).alias("x"))
    met = met.select(F.xxhash64("root", "x.a", "x.pa", "x.b", "x.pb").alias("block"),
                     ((F.col("level") == F.col("x.a")) & (F.col("part") == F.col("x.pa"))).alias("first"),
                     ((F.col("x.a") == F.col("x.b")) & (F.col("x.pa") == F.col("x.pb"))).alias("same"), "cls", "n", "windows")
    met = met.repartition("block").sortWithinPartitions("block")
    return met.mapInArrow(_compare(similarity), "cls binary, linked long, head binary")


def _window_sets(n: int):
    def sets(texts: list[str]) -> dict[str, list]:
        words, at = word_hashes_of(texts)
        keys, data, sizes = [], [], []
        for i, text in enumerate(texts):
            w = words[at[i]:at[i + 1]]
            s = np.unique(shingle_hashes(w, n))
            keys.append(class_key(w, text))
            data.append(s.tobytes())
            sizes.append(len(s))
        return {"cls": keys, "windows": data, "n_distinct": sizes}

    return sets


def _compare(similarity: float):
    out = pa.schema([("cls", pa.binary()), ("linked", pa.int64()), ("head", pa.binary())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(names)) + 1
            for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(names)]))):
                if a == b:
                    continue
                if rows and names[a] != block:
                    yield from links(rows)
                    rows = []
                block = names[a]
                rows += zip(*(c.slice(a, b - a).to_pylist() for c in batch.columns[1:]))
        if rows:
            yield from links(rows)

    def links(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = [(f or same, same, c, n, w) for f, same, c, n, w in rows]
        if len(rows) < 2:
            return
        same = rows[0][1]
        rows.sort(key=lambda r: not r[0])
        left = len(rows) if same else sum(r[0] for r in rows)
        if not same and (left == 0 or left == len(rows)):
            return
        linked = similar([np.frombuffer(r[4], dtype=np.uint64) for r in rows], left, same, similarity)
        weight = np.array([r[3] for r in rows], dtype=np.int64)
        degree = linked @ weight
        some = np.flatnonzero(degree)
        if not len(some):
            return
        root = spanning(linked)
        yield pa.RecordBatch.from_arrays([pa.array([rows[i][2] for i in some], pa.binary()), pa.array(degree[some], pa.int64()),
                                          pa.array([rows[root[i]][2] for i in some], pa.binary())], schema=out)

    return compare


def similar(sets: list[np.ndarray], left: int, same: bool, similarity: float) -> np.ndarray:
    """Symmetric boolean matrix: which sets have a Jaccard similarity of
    ``similarity`` or more, exactly. Unless ``same``, only the first ``left``
    against the rest. Sets are unions of matrix columns, ``COLUMNS`` at a time."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    every, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    right = 0 if same else left
    common = np.zeros((left, len(sets) - right))
    for at in range(0, len(every), COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        m = np.zeros((len(sets), min(COLUMNS, len(every) - at)), dtype=np.float32)
        m[row[a:b], column[a:b] - at] = 1
        m = m[:, m.sum(axis=0) > 1]  # what only one set has is in no intersection
        common += m[:left] @ m[right:].T
    part = common >= similarity * (size[:left, None] + size[None, right:] - common) - 1e-6 * size[:left, None]
    part &= common > 0
    linked = np.zeros((len(sets), len(sets)), dtype=bool)
    linked[:left, right:] = part
    linked |= linked.T
    np.fill_diagonal(linked, False)
    return linked


def spanning(linked: np.ndarray) -> np.ndarray:
    """For each row the first row of its connected part."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] >= 0:
            continue
        todo = [i]
        root[i] = i
        while todo:
            for j in np.flatnonzero(linked[todo.pop()] & (root < 0)):
                root[j] = i
                todo.append(int(j))
    return root


def keep_one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of :func:`jaccard_classes`: that with
    the smallest doc_id (a null one last), of rows that repeat a doc_id that
    with the smallest hash of its text. Fully repeated rows are one row's
    copies, of which any may stay; rows of other classes all stay, whatever
    their doc_id."""
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    # classes are found by row, named by a key that orders rows as above
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), th.alias("th"))
    classes = jaccard_classes(docs.select(key.alias("doc_id"), "text"), **options)
    kept = classes.where("doc_id = class_id").select(F.col("class_id.id").alias("_id"), F.col("class_id.th").alias("_th")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own"), th.alias("th"))  # packed, so that no column's name can clash
    both = rows.join(kept, F.col("own").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left_semi")
    one = both.dropDuplicates(["own", "th"])
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
