"""Sort, limit, top-k, distinct, split-out and order-based sequence operators.

Rows in Spark have no order, so every order-sensitive operator takes
``order_by`` columns that end in a unique key. Nothing here uses a window
without ``partitionBy`` (that would pull all rows into one task); global
positions come from :func:`positions`, which splits even a single hot key
across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsvalues import path_col


def _cols(names: Sequence[str | Column] | str | Column | None) -> list[Column]:
    if names is None:
        return []
    if isinstance(names, (str, Column)):
        names = [names]
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


# --------------------------------------------------------------------------
# exact positions without a hot task
# --------------------------------------------------------------------------


def positions(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
              name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position of each row within its key, in ``order_by`` order.

    ``order_by`` must be unique within a key. The rows are range-partitioned
    on (keys, order), so one key that holds a third of the data is spread
    over many tasks. Each task numbers its slice locally; a small table of
    (partition, key, count) gives every slice its offset. This is the
    per-key form of ``zipWithIndex`` in DataFrame operations.
    """
    keys = list(keys)
    order = _cols(order_by)
    n = num_partitions or _shuffle_partitions(df)
    # The range exchange runs once and is kept (memory, then disk): both
    # branches below must see the very same partitions. Two separate range
    # exchanges would sample their bounds independently.
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn(
        "_part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    wl = Window.partitionBy("_part", *keys).orderBy(*order)
    local = ranged.withColumn("_local", F.row_number().over(wl) - 1)
    if not keys:
        # global positions: one count per range partition (at most n rows),
        # turned into offsets on the driver and applied as a literal map
        cnt = dict(ranged.groupBy("_part").count().collect())
        offs, run = [], 0
        for part in sorted(cnt):
            offs += [F.lit(part), F.lit(run)]
            run += cnt[part]
        m = F.create_map(*offs) if offs else F.create_map().cast("map<int,bigint>")
        return local.withColumn(name, (F.coalesce(F.try_element_at(m, F.col("_part")), F.lit(0))
                                       + F.col("_local")).cast("long")).drop("_part", "_local")
    counts = ranged.groupBy("_part", *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_cnt"))
    kk = [f"_key{i}" for i in range(len(keys))]
    # at most n rows per key here (one per range partition)
    wo = (Window.partitionBy(*kk) if kk else Window.partitionBy(F.lit(0))).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(wo), F.lit(0))) \
        .drop("_cnt").withColumnRenamed("_part", "_opart")
    cond = [local["_part"] == offsets["_opart"]] + [
        local[k].eqNullSafe(offsets[kk[i]]) for i, k in enumerate(keys)]
    joined = local.join(offsets, on=cond, how="inner")
    return joined.withColumn(name, (F.col("_off") + F.col("_local")).cast("long")).drop(
        "_part", "_local", "_off", "_opart", *kk)


def carry_forward(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], marker: str,
                  out: str, include_current: bool = False,
                  num_partitions: int | None = None) -> DataFrame:
    """``out`` = the last non-null ``marker`` before each row (or up to and
    including it) within its key, in ``order_by`` order.

    Same split as :func:`positions`: rows are range-partitioned so one long
    key spreads over many tasks; each task carries values forward inside its
    slice, and the last value of every earlier slice of the key (a table of
    at most one row per partition and key) fills the start of the next.
    """
    keys = list(keys)
    order = _cols(order_by)
    n = num_partitions or _shuffle_partitions(df)
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn(
        "_part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    hi = 0 if include_current else -1
    wl = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    local = ranged.withColumn("_loc", F.last(F.col(marker), ignorenulls=True).over(wl))
    kk = [f"_key{i}" for i in range(len(keys))]
    kcols = [F.col(k).alias(kk[i]) for i, k in enumerate(keys)]
    slices = ranged.groupBy("_part", *kcols).agg(
        F.max_by(F.col(marker), F.when(F.col(marker).isNotNull(), F.struct(*order))).alias("_val"))
    wk = (Window.partitionBy(*kk) if kk else Window.partitionBy(F.lit(0))).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("_car", F.last("_val", ignorenulls=True).over(wk)) \
        .select(F.col("_part").alias("_opart"), *kk, "_car")
    cond = [local["_part"] == carried["_opart"]] + [
        local[k].eqNullSafe(carried[kk[i]]) for i, k in enumerate(keys)]
    j = local.join(carried, on=cond, how="inner")
    return j.withColumn(out, F.coalesce(F.col("_loc"), F.col("_car"))).drop(
        "_part", "_loc", "_car", "_opart", *kk)


# --------------------------------------------------------------------------
# sort / limit
# --------------------------------------------------------------------------


def sort_key(df: DataFrame, by: str, binary: bool = False) -> Column:
    c, dtype = path_col(df, by)
    if not binary and isinstance(dtype, T.StringType):
        return F.collate(c, "UNICODE")
    return c


def sort_rows(df: DataFrame, by: str | None, order: str = "ascending",
              tiebreak: Sequence[str] = (), binary: bool = False, seed: int = 0) -> DataFrame:
    """Sort by a path: nulls first ascending, last descending; text by locale
    (``UNICODE`` collation) unless ``binary``; ``tiebreak`` keeps it stable."""
    if order == "random":
        return df.orderBy(F.rand(seed))
    keys = []
    if by:
        k = sort_key(df, by, binary)
        keys.append(k.desc_nulls_last() if order == "descending" else k.asc_nulls_first())
    keys += [F.col(t).asc() for t in tiebreak]
    return df.orderBy(*keys)


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str | Column],
               keep: str = "first") -> DataFrame:
    """First or last ``n`` rows in ``order_by`` order (planned as TakeOrdered)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    order = _cols(order_by)
    if keep == "first":
        return df.orderBy(*order).limit(n)
    if keep == "last":
        return df.orderBy(*[o.desc() for o in order]).limit(n).orderBy(*order)
    raise ValueError(keep)


def rerank(df: DataFrame, k: int, by: Sequence[str] = (), score_col: str = "score",
           tiebreak: str = "id") -> DataFrame:
    """Score descending (missing = 0), keep ``k`` per group ``by``."""
    s = F.coalesce(F.col(score_col).cast("double"), F.lit(0.0))
    if not by:
        return df.orderBy(s.desc(), F.col(tiebreak)).limit(k)
    return top_k(df, by, s, k, tiebreak=tiebreak)


def top_k(df: DataFrame, by: Sequence[str], score: str | Column, k: int,
          tiebreak: str | None = None, rank_col: str = "rank", descending: bool = True) -> DataFrame:
    """Best ``k`` rows per group. ``row_number() <= k`` is planned with a
    partial window group limit before the shuffle, so a hot group sends at
    most ``k`` rows per map task."""
    sc = F.col(score) if isinstance(score, str) else score
    order = [sc.desc() if descending else sc.asc()]
    if tiebreak:
        order.append(F.col(tiebreak).asc())
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


# --------------------------------------------------------------------------
# distinct
# --------------------------------------------------------------------------


def _group_key(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def remove_duplicates(df: DataFrame, fields: Sequence[str] | None = None,
                      order_by: Sequence[str] | None = None) -> DataFrame:
    """First row of each set of equal rows (or equal ``fields``).

    With ``order_by`` the first row is ``min_by`` per key: a partial
    aggregate, so a key with millions of copies is reduced map-side.
    Without it any one row per key is kept (``dropDuplicates``).
    """
    fields = [f for f in (fields or []) if f]
    key_exprs = []
    if fields:
        for i, f in enumerate(fields):
            c, t = path_col(df, f)
            key_exprs.append(_group_key(c, t).alias(f"_k{i}"))
    else:
        for i, f in enumerate(df.schema.fields):
            key_exprs.append(_group_key(F.col(f"`{f.name}`"), f.dataType).alias(f"_k{i}"))
    keyed = df.select(*key_exprs, *[F.col(f"`{c}`") for c in df.columns])
    knames = [f"_k{i}" for i in range(len(key_exprs))]
    if not order_by:
        return keyed.dropDuplicates(knames).select(*[F.col(f"`{c}`") for c in df.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = keyed.groupBy(*knames).agg(F.min_by(row, F.struct(*_cols(order_by))).alias("_r"))
    return first.select("_r.*")


# --------------------------------------------------------------------------
# split out / loop / batches
# --------------------------------------------------------------------------


def split_out(df: DataFrame, field: str) -> DataFrame:
    """One row per list element; scalars kept; missing values and empty lists dropped."""
    if field not in df.columns:
        return df.filter(F.lit(False))
    dtype = df.schema[field].dataType
    if isinstance(dtype, T.ArrayType):
        return df.withColumn(field, F.explode(F.col(field)))
    return df.filter(F.col(field).isNotNull())


def iterate(df: DataFrame, col: str, max_iterations: int = 100, item: str = "item",
            index: str = "index", on_limit: str = "raise") -> DataFrame:
    """Loop block: list to rows with index, total, is_last.

    A scalar is one item and null is none. A list over ``max_iterations`` is an
    error (``on_limit='raise'``, raised inside the task with ``raise_error``)
    or is reported in an ``error`` column (``on_limit='flag'``).
    """
    dtype = df.schema[col].dataType
    arr = F.col(col) if isinstance(dtype, T.ArrayType) else F.when(
        F.col(col).isNull(), F.array().cast(T.ArrayType(dtype))).otherwise(F.array(F.col(col)))
    total = F.size(arr)
    over = total > F.lit(max_iterations)
    base = df.withColumn("_arr", arr).withColumn("total", F.size("_arr"))
    if on_limit == "raise":
        base = base.withColumn("_arr", F.when(over, F.raise_error(F.concat(
            F.lit("Loop has "), total.cast("string"),
            F.lit(f" items, exceeds max_iterations={max_iterations}")))).otherwise(F.col("_arr")))
        flagged = base
    else:
        flagged = base.withColumn("error", F.when(over, F.concat(
            F.lit("Loop has "), total.cast("string"),
            F.lit(f" items, exceeds max_iterations={max_iterations}"))))
        flagged = flagged.withColumn("_arr", F.when(over, F.array().cast(
            flagged.schema["_arr"].dataType)).otherwise(F.col("_arr")))
    out = flagged.select("*", F.posexplode("_arr").alias(index, item)).drop("_arr")
    return out.withColumn("is_last", F.col(index) == F.col("total") - 1)


def batch(df: DataFrame, n: int, order_by: Sequence[str], partition_by: Sequence[str] = (),
          name: str = "batch_no") -> DataFrame:
    """Batches of ``n`` rows per partition key, in order (exact, skew-safe)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    p = positions(df, list(partition_by), order_by, name="_pos")
    return p.withColumn(name, F.floor(F.col("_pos") / n).cast("long")).withColumn(
        "pos_in_batch", (F.col("_pos") % n).cast("long")).drop("_pos")


def truncate_text(df: DataFrame, col: str, n: int, note: str | None = None,
                  out: str | None = None) -> DataFrame:
    """Cut text over ``n`` characters; ``note`` may use ``{total}`` and ``{kept}``."""
    c = F.col(col)
    if note is None:
        cut = F.substring(c, 1, n)
    else:
        parts = note.replace("{kept}", "\x00K\x00").replace("{total}", "\x00T\x00").split("\x00")
        pieces = []
        for p in parts:
            if p == "K":
                pieces.append(F.lit(str(n)))
            elif p == "T":
                pieces.append(F.char_length(c).cast("string"))
            elif p:
                pieces.append(F.lit(p))
        cut = F.concat(F.substring(c, 1, n), *pieces)
    return df.withColumn(out or col, F.when(F.char_length(c) > n, cut).otherwise(c))
