"""Aggregations: summarize, collect, group counts, facets and log rollups.

All folds are plain ``groupBy().agg()`` so Spark runs a partial (map-side)
aggregate before the shuffle: a key holding a third of the rows costs one
partial row per task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsvalues import js_number, js_string, path_col
from tessera.operators.ordering import positions


def summarize(df: DataFrame, by: str | None, aggs: Sequence[tuple[str, str]]) -> DataFrame:
    """Summarize block.

    ``by``: group path; the key becomes ``String(v ?? "")`` so null joins the
    ``""`` group. ``aggs``: ``(fn, field)`` with fn in count/sum/avg/min/max;
    output columns are ``<fn>_<field>`` (``count_items`` for a bare count).
    Sum and avg of nothing are 0, min and max of nothing are null.
    """
    exprs: list[Column] = []
    for fn, field in aggs:
        name = f"{fn}_{field or 'items'}"
        if field:
            c, t = path_col(df, field)
            num = js_number(c, t)
        else:
            c, t, num = None, None, None
        if fn == "count":
            exprs.append((F.count(c) if field else F.count(F.lit(1))).cast("long").alias(name))
        elif fn == "sum":
            exprs.append(F.coalesce(F.sum(num), F.lit(0.0)).alias(name))
        elif fn == "avg":
            exprs.append(F.coalesce(F.avg(num), F.lit(0.0)).alias(name))
        elif fn == "min":
            exprs.append(F.min(num).alias(name))
        elif fn == "max":
            exprs.append(F.max(num).alias(name))
        else:
            raise ValueError(f"unknown aggregate {fn}")
    if not by:
        return df.agg(*exprs) if exprs else df.agg(F.count(F.lit(1)).alias("count_items")).select()
    kc, kt = path_col(df, by)
    key = F.coalesce(js_string(kc, kt), F.lit("")) if not isinstance(kt, T.NullType) else F.lit("")
    return df.groupBy(key.alias(by)).agg(*exprs)


def collect_field(df: DataFrame, field: str, order_by: Sequence[str], by: Sequence[str] = (),
                  page_size: int = 10_000) -> DataFrame:
    """Aggregate block, field mode: the values of one field in order, missing dropped.

    Re-aimed for scale: one output row per group key and *page* of at most
    ``page_size`` values (page 0, 1, ...), so no single row or task ever holds
    an unbounded group. Positions come from the skew-safe ``positions``.
    """
    c, _ = path_col(df, field)
    src = df.select(*[F.col(b) for b in by], *[F.col(o) for o in order_by], c.alias("_v")) \
        .filter(F.col("_v").isNotNull())
    p = positions(src, list(by), order_by, name="_pos")
    p = p.withColumn("page", F.floor(F.col("_pos") / page_size).cast("long"))
    out = p.groupBy(*by, "page").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_pos"), F.col("_v")))).alias("_l"))
    return out.select(*by, "page", F.transform("_l", lambda s: s["_v"]).alias(field))


def collect_rows(df: DataFrame, order_by: Sequence[str], by: Sequence[str] = (),
                 name: str = "data", page_size: int = 10_000) -> DataFrame:
    """Aggregate block, all-items mode: rows as a list of structs, in order,
    one output row per group and page (see :func:`collect_field`)."""
    cols = [c for c in df.columns]
    p = positions(df, list(by), order_by, name="_pos")
    p = p.withColumn("page", F.floor(F.col("_pos") / page_size).cast("long"))
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    out = p.groupBy(*by, "page").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_pos"), row.alias("r")))).alias("_l"))
    return out.select(*by, "page", F.transform("_l", lambda s: s["r"]).alias(name))


def group_count(df: DataFrame, key: str, filter_key: str | None = None,
                filter_value: str | None = None, meta_col: str | None = None) -> DataFrame:
    """Count by one metadata key (optionally after ``filter_key = filter_value``),
    with the total of all groups on every row."""
    def val(k: str) -> Column:
        if meta_col is None:
            return F.col(k).cast("string")
        return F.try_element_at(F.col(meta_col), F.lit(k))
    src = df
    if filter_key is not None:
        src = src.filter(F.coalesce(val(filter_key) == F.lit(filter_value), F.lit(False)))
    g = src.groupBy(val(key).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    # the total is a scalar subquery over the grouped counts (no one-task window)
    return g.withColumn("total", g.select(F.sum("count")).scalar().cast("long"))


def facets(df: DataFrame, fields: Sequence[str], limit: int = 20, meta_col: str | None = None) -> DataFrame:
    """Top ``limit`` values with counts for each field, plus per-field totals.

    One pass: each row becomes (field, value) pairs, one ``groupBy`` counts
    them (partial aggregate first), and a window group limit keeps the top
    values per field. Ties are broken by value so the result is exact.
    """
    def val(k: str) -> Column:
        if meta_col is None:
            return F.col(k).cast("string")
        return F.try_element_at(F.col(meta_col), F.lit(k))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), val(f).alias("value")) for f in fields])
    long = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    counts = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("field").orderBy(F.col("count").desc(), F.col("value").asc())
    # top values per field: a window group limit (partial top-k before the shuffle)
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    # totals per field: a grouped sum with one row per field, joined back
    totals = counts.groupBy("field").agg(F.sum("count").cast("long").alias("total"))
    return top.join(F.broadcast(totals), "field")


def collection_stats(chunks: DataFrame, jobs: DataFrame | None = None,
                     key: str = "collection", file_col: str = "document_id") -> DataFrame:
    """Files, vectors and active jobs per collection."""
    s = chunks.groupBy(key).agg(
        F.count_distinct(F.col(file_col)).alias("files"),
        F.count(F.lit(1)).alias("vectors"))
    if jobs is None:
        return s.withColumn("active_jobs", F.lit(0).cast("long"))
    j = jobs.filter(F.col("status").isin("queued", "running")).groupBy(key).agg(
        F.count(F.lit(1)).alias("active_jobs"))
    return s.join(j, key, "left").fillna({"active_jobs": 0})


def job_progress(df: DataFrame, job_col: str = "job_id") -> DataFrame:
    """Per job: total, projected, state and progress = projected / total."""
    g = df.groupBy(job_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("projected"), 1).otherwise(0)).alias("projected"))
    return g.withColumn("progress", F.round(F.col("projected") / F.col("total"), 4)).withColumn(
        "state", F.when(F.col("projected") == F.col("total"), "completed")
        .when(F.col("projected") == 0, "pending").otherwise("running"))


def run_rollup(logs: DataFrame, by: Sequence[str] = ("run_id", "block_id")) -> DataFrame:
    """Per run and block: counts of each event kind and duration statistics."""
    ev = F.col("event")
    def n(kind: str) -> Column:
        return F.sum(F.when(ev == kind, 1).otherwise(0)).cast("long").alias(kind)
    return logs.groupBy(*by).agg(
        n("started"), n("completed"), n("failed"), n("skipped"), n("timeout"),
        F.sum("duration_ms").cast("long").alias("total_ms"),
        F.max("duration_ms").cast("long").alias("max_ms"),
    )


def agent_stats(runs: DataFrame, by: Sequence[str] = ("agent_id", "status")) -> DataFrame:
    """Runs by status with token and duration totals."""
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("tokens_used").cast("long").alias("tokens"),
        F.round(F.avg("duration_ms"), 4).alias("avg_ms"),
        F.max("duration_ms").cast("long").alias("max_ms"))


def event_stats(events: DataFrame, run_col: str = "run_id", ts_col: str = "ts") -> DataFrame:
    """Per run: turns, tool calls, tool errors, policy violations, duration
    from the first start event to the last end event (seconds)."""
    t = F.col("type")
    def n(kind: str, name: str) -> Column:
        return F.sum(F.when(t == kind, 1).otherwise(0)).cast("long").alias(name)
    g = events.groupBy(run_col).agg(
        n("turn_start", "turns"), n("tool_call", "tool_calls"), n("tool_error", "tool_errors"),
        n("policy_violation", "violations"),
        F.min(F.when(t == "agent_start", F.col(ts_col))).alias("_s"),
        F.max(F.when(t == "agent_end", F.col(ts_col))).alias("_e"))
    return g.withColumn("duration_s", F.round(
        (F.unix_micros(F.col("_e").cast("timestamp")) - F.unix_micros(F.col("_s").cast("timestamp"))) / 1e6, 3)
    ).drop("_s", "_e")


# fixed values: migration price per million vectors and the free tier
CENTS_PER_MILLION_RETAINED = 10
CENTS_PER_MILLION_ELSE = 50
FREE_VECTORS = 100_000


def quote(df: DataFrame, retain: bool = True, vec_col: str = "embedding") -> DataFrame:
    """Price of a migration: the first ``FREE_VECTORS`` are free, the rest costs
    the rate of vectors kept (``retain``) or not, in whole cents, rounded up."""
    rate = CENTS_PER_MILLION_RETAINED if retain else CENTS_PER_MILLION_ELSE
    g = df.agg(F.count(F.lit(1)).alias("n_total_vectors"), F.coalesce(F.max(F.size(vec_col)), F.lit(0)).alias("src_dim"))
    billable = F.greatest(F.col("n_total_vectors") - F.lit(FREE_VECTORS), F.lit(0))
    cents = F.ceil(billable * rate / 1e6).cast("long")
    return g.withColumn("retain_on_cloud", F.lit(retain)).withColumn("rate_per_million_cents", F.lit(rate)).withColumn("quote_cents", cents) \
        .withColumn("quote_usd", F.col("quote_cents") / 100).withColumn("free_tier", F.col("n_total_vectors") <= FREE_VECTORS) \
        .withColumn("requires_payment", F.col("quote_cents") > 0)
