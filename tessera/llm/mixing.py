"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact word length per source. A source whose target
is ``q`` whole passes and a rest takes every document ``q`` times; the rest is
fitted by choosing how many documents of each length are taken once more: by a
an even share of every length first, then the longest that still fit, and for
the last budget a bounded-knapsack dynamic programme over the lengths left. Its
range is four times the longest document, so no document is too long for it (one
of 10 million words needs 250 MB of a task); where it holds the whole budget and
the share does not meet it, the programme fits all of it. Which documents of a
length these are is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import plain_word_count
from tessera.operators.ordering import positions
from tessera.session import cut_lineage

# fixed values: weights by rank of the source, repeating; most copies of a document
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: documents of one source and length that are ranked together at most, on average
RANK_GROUP = 20_000
#: words that the dynamic programme covers: this many, or so many times the longest document if that is more
DP_BUDGET, DP_LONGEST = 20_000, 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` rows.

    Sources by code point, null last, get the weights in turn and share the
    sum of all sizes by weight. A target above ``max_copies`` times its source
    stops there, and the excess is shared again by weight among the others,
    until none is above. That ends at one water level: sources whose
    ``max_copies * size / weight`` is below it are full, all others get
    ``weight * level``. Each round of sharing is one aggregate over the sources
    (a row each) that brings three sums to the driver.
    """
    place = positions(sizes.select("source", "source_size"), [], [F.col("source").asc_nulls_last()], name="place")
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights)).cast("int"))
    t = cut_lineage(place.select("source", "source_size", w.alias("w"), (F.lit(float(max_copies)) * F.col("source_size")).alias("cap")))
    level, n_full = 0.0, -1
    while True:
        full = F.col("w") * level > F.col("cap")
        r = t.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("cap"))).alias("held"),
                  F.sum(F.when(~full, F.col("w"))).alias("w"), F.count_if(full).alias("n")).first()
        if r["n"] == n_full or not r["w"]:
            break
        level, n_full = ((r["all"] or 0) - (r["held"] or 0.0)) / r["w"], r["n"]
    return t.select("source", "source_size", F.least("cap", F.col("w") * level).alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their sum is near
    ``budget`` and not above it. Lengths are distinct and positive."""
    take = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    reach = max(DP_BUDGET, DP_LONGEST * int(lengths[counts > 0].max()))
    take = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    left = budget - int((lengths * take).sum())
    for i in np.argsort(-lengths, kind="stable"):  # one more of each, then all that fit, longest first
        if left <= reach:
            break
        n = min(int(counts[i] - take[i]), -(-(left - reach) // int(lengths[i])))
        take[i] += n
        left -= n * int(lengths[i])
    take += bounded_knapsack(lengths, counts - take, left)
    if int((lengths * take).sum()) < budget <= reach:  # the even share stood in the way: without it the programme finds the best sum there is
        return bounded_knapsack(lengths, counts, budget)
    return take


def bounded_knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts within ``counts`` whose sum of lengths is the largest not above
    ``budget`` (exact). The counts are split into powers of two; ``via[s]`` is
    the first piece with which sum ``s`` is reached. Stops when the budget
    itself is reached."""
    take = np.zeros(len(lengths), dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    via = np.full(budget + 1, -1, dtype=np.int32)
    pieces: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable"):
        n, size, part = min(int(counts[i]), budget // max(int(lengths[i]), 1)), int(lengths[i]), 1
        while n > 0 and size > 0:
            k = min(part, n)
            step = size * k
            if step <= budget:
                new = np.zeros_like(reached)
                new[step:] = reached[: budget + 1 - step]
                new &= ~reached
                via[new] = len(pieces)
                pieces.append((int(i), k))
                reached |= new
            n, part = n - k, part * 2
        if reached[budget]:
            break
    s = int(np.flatnonzero(reached)[-1])
    while s > 0:  # a sum was reached from one that earlier pieces had made, so no piece serves twice
        i, k = pieces[via[s]]
        take[i] += k
        s -= int(lengths[i]) * k
    return take


def mix_sources(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
                keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_size, _source_size, _target, _taken, _copies`` (words
    the mix takes of the document, repeats counted, and how often it is taken);
    they replace columns of these names. Without ``keep_text`` the texts are
    left out of the result and so of its shuffles.

    Reads ``doc_id, source, text``. A document's size is its number of plain
    words (null and empty: 0, never taken). Equal documents are told apart by
    doc_id, fully repeated rows at random but with the same counts; a null
    source is a source of its own. No rows give no rows.
    """
    # the row is packed, so that no column's name can clash
    added = ["_size", "_source_size", "_target", "_copies", "_taken"]
    kept = [c for c in docs.columns if c not in added and (keep_text or c != "text")]
    size = docs.select(F.struct(*kept).alias("row"), "doc_id", "source", plain_word_count(F.col("text")).alias("_size"))
    narrow = size.select("doc_id", "source", "_size")
    by_length = cut_lineage(narrow.groupBy("source", "_size").agg(F.count(F.lit(1)).alias("n")))
    targets = source_targets(by_length.groupBy("source").agg(F.sum(F.col("n") * F.col("_size")).alias("source_size")), weights, max_copies)

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        """Extra takes of each length of one source; as many rows as lengths."""
        pdf = pdf.sort_values("_size", kind="stable").reset_index(drop=True)
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = min(int(target // total), max_copies) if total else 0
        budget = int(round(target - passes * total)) if total and passes < max_copies else 0
        lengths, counts = pdf["_size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        some = lengths > 0
        extra = np.zeros(len(pdf), dtype=np.int64)
        extra[some] = fit_counts(lengths[some], counts[some], budget)
        left = budget - int((lengths * extra).sum())
        if left > 0:  # once more of each cannot make it up, so some are repeated as often as the limit lets them
            extra[some] += fit_counts(lengths[some], (counts * (max_copies - passes) - extra)[some], left)
        pdf["source"] = pdf["source"].astype(object)
        return pdf.assign(passes=passes + extra // counts, extra=extra % counts, groups=-(-counts // RANK_GROUP))[
            ["source", "_size", "source_size", "target", "passes", "extra", "groups"]]

    targets = targets.withColumnRenamed("source", "_s")
    hist = by_length.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    src_type = narrow.schema["source"].dataType.simpleString()
    plans = hist.groupBy("source").applyInPandas(
        plan, f"source {src_type}, _size long, source_size long, target double, passes long, extra long, groups long")
    p = plans.select(F.col("source").alias("_s"), F.col("_size").alias("_z"), F.col("source_size").alias("_source_size"),
                     F.col("target").alias("_target"), "passes", "extra", "groups")
    full = size.join(p, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z"))).drop("_s", "_z")
    # hot lengths are ranked in several groups; a group's takes follow from the sizes of those before it
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.lit("order"))
    full = full.withColumn("_o", order).withColumn("_g", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("groups")))
    per_group = full.groupBy("source", "_size", "_g").agg(F.count(F.lit(1)).alias("in_group"))
    ahead = per_group.withColumn("ahead", F.coalesce(F.sum("in_group").over(
        Window.partitionBy("source", "_size").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ahead = ahead.select(F.col("source").alias("_s"), F.col("_size").alias("_z"), F.col("_g").alias("_h"), "ahead").where("_h > 0")
    full = full.join(ahead, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")) & (F.col("_g") == F.col("_h")), "left")
    rank = F.row_number().over(Window.partitionBy("source", "_size", "_g").orderBy("_o", "doc_id"))
    copies = F.col("passes") + (rank + F.coalesce("ahead", F.lit(0)) <= F.col("extra")).cast("long")
    copies = F.when(F.col("_size") > 0, copies).otherwise(F.lit(0).cast("long"))
    full = full.withColumn("_copies", copies).withColumn("_taken", F.col("_copies") * F.col("_size"))
    return full.select(*[F.col("row").getField(c).alias(c) for c in kept], *added)
