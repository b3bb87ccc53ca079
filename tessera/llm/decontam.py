"""Benchmark decontamination by a prefix-filtered set join, DataFrame functions only.

A window is 10 consecutive folded words of a benchmark item (a shorter item is
one window). Seen as a set of 3-word shingles, a window lies in a document
only if all of its shingles do, so the prefix that must be joined is its one
rarest shingle, by counts over the whole corpus. Where that shingle is found,
its place fixes where the window would start; start and length must lie inside
the document, and then every shingle of the window must stand at its place,
which is to say that all words are equal, in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import folded_words
from tessera.session import cut_lineage

WINDOW = 10
SHINGLE = 3
#: bytes of benchmark rows that are broadcast at once; more take further passes over the documents
BROADCAST_BYTES = 16 << 20


def benchmark_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, win`` of every item: its windows as word arrays."""
    items = bench.select("item_id", folded_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    return items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("win")).distinct()


def _blocks(rows: DataFrame, width: int, key: str) -> list[DataFrame]:
    """``rows`` of ``width`` bytes each as parts of about BROADCAST_BYTES, by
    hash of ``key``; they are counted first, so each broadcast has a checked size."""
    n = max(1, -(-rows.count() * width // BROADCAST_BYTES))
    return [F.broadcast(rows if n == 1 else rows.where(F.pmod(F.xxhash64(F.lit("block"), key), F.lit(n)) == i)) for i in range(n)]


def _places(texts: DataFrame, k: int) -> DataFrame:
    """``doc_id, th, p, h``: every place of every document with the hash of the
    ``k`` words there. A text of fewer words has one place that matches nothing."""
    d = texts.select("doc_id", "th", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - k, F.lit(0)))).alias("p"))
    return d.select("doc_id", "th", "p", F.xxhash64(F.lit(k), *[F.get("words", F.col("p") + j) for j in range(k)]).alias("h"))


def window_matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """``doc_id, th, start, size, win_id`` of every occurrence of a window
    in a document (``th`` is a hash of the text), and ``win_id, item_id``.

    The documents are read once: every place with a shingle of the benchmark
    is stored, which is what counting, joining and verifying need. A window
    occurs where all of its shingles stand at their places, that is, where all
    of its words do.
    """
    wins = cut_lineage(benchmark_windows(bench, window))
    ids = wins.select("item_id", F.xxhash64("win").alias("win_id"))
    distinct = wins.select("win").distinct().select(F.xxhash64("win").alias("win_id"), "win", F.size("win").alias("size"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("th"), folded_words(F.col("text")).alias("words"))
    found = None
    # windows of fewer than SHINGLE words have shingles of their own length: SHINGLE values at most
    for k in sorted(r[0] for r in distinct.select(F.least("size", F.lit(shingle)).alias("k")).distinct().collect()):
        some = distinct.where(F.least("size", F.lit(shingle)) == k)
        hashed = F.transform(F.sequence(F.lit(0), F.col("size") - k), lambda o: F.struct(
            o.alias("off"), F.xxhash64(F.lit(k), *[F.get("win", o + j) for j in range(k)]).alias("h")))
        shingles = cut_lineage(some.select("win_id", "size", F.explode(hashed).alias("x")).select("win_id", "size", "x.off", "x.h"))
        parts = [_places(texts, k).join(part, "h") for part in _blocks(cut_lineage(shingles.select("h").distinct()), 16, "h")]
        places = parts[0]
        for part in parts[1:]:
            places = places.union(part)
        places = cut_lineage(places)
        # the necessary prefix: the shingle of each window that is rarest in the corpus; one that no document has rules the window out
        counts = places.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        ranked = shingles.join(counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        first = F.row_number().over(Window.partitionBy("win_id").orderBy("n", "off"))
        prefix = cut_lineage(ranked.withColumn("r", first).where("r = 1 AND n > 0").select("win_id", "size", "off", "h"))
        for part in _blocks(prefix, 40, "win_id"):
            start = F.col("p") - F.col("off")
            # a window of which only the prefix is there is cut out by the next step; a start before the text here
            maybe = places.join(part, "h").select("doc_id", "th", start.alias("start"), "win_id").where("start >= 0")
            # full check: each of the window's shingles at its place
            want = maybe.join(shingles, "win_id").select(
                "doc_id", "th", "start", "win_id", "size", (F.col("start") + F.col("off")).alias("p"), "h")
            there = places.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("p").alias("_p"), F.col("h").alias("_h")).distinct()
            seen = want.join(there, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
                             & (F.col("p") == F.col("_p")) & (F.col("h") == F.col("_h")), "left_semi")
            whole = seen.groupBy("doc_id", "th", "start", "win_id", "size").agg(F.count_distinct("p").alias("c")).where(
                F.col("c") == F.col("size") - k + 1)
            hits = whole.select("doc_id", "th", "start", "size", "win_id")
            found = hits if found is None else found.union(hits)
    if found is None:  # a benchmark without words
        found = texts.where(F.lit(False)).select("doc_id", "th", F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("win_id"))
    return cut_lineage(found), ids


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Reads ``doc_id, text`` and ``item_id, text``; other columns are ignored.
    A word is hit if it lies inside any occurrence of a window. Null and empty
    texts have no words and are clean; items without words match nothing.
    Repeated rows get equal results; an empty table gives no rows, an empty
    benchmark no hits.
    """
    found, ids = window_matches(docs, bench, window)
    key = ["doc_id", "th"]
    spans = found.select(*key, "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    text = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(text), F.lit(0))))
    hit = spans.withColumn("new", new).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    items = found.select(*key, "win_id").distinct().join(ids, "win_id").select(*key, "item_id").distinct()
    items = items.groupBy(*key).agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))  # items of one document
    marks = hit.join(items, hit["doc_id"].eqNullSafe(items["doc_id"]) & (hit["th"] == items["th"])).select(
        hit["doc_id"].alias("_id"), hit["th"].alias("_th"), "n_hit", "items")
    t = F.coalesce("text", F.lit(""))
    # case doesn't change how many words there are
    n_words = F.size(F.array_remove(F.split(t, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), ""))
    all_docs = docs.select("doc_id", F.xxhash64(t).alias("th"), n_words.cast("long").alias("n_words"))
    both = all_docs.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return both.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                       F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs."""
    found, _ = window_matches(docs, bench, window)
    bad = found.select(F.col("doc_id").alias("id"), F.col("th").alias("hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    clean = rows.join(bad, F.col("own").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash")), "left_anti")
    return clean.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
