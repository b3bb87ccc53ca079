"""Filters and predicates (item filter, condition node, search-time filters).

Each spec is turned into ONE boolean Column on the driver; Spark evaluates it
inside whole-stage codegen and pushes the parts it can (plain comparisons on
real columns) into the parquet scan.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsvalues import (
    family,
    js_number,
    js_number_literal,
    js_string,
    js_string_literal,
    js_truthy,
    lit_family,
    resolve_operand,
)



@dataclass(frozen=True)
class Cond:
    """One item-filter condition: ``left`` operand, operation, right value."""

    left: Any
    op: str = "equals"
    right: Any = None


def _cond(c: Cond | tuple | dict) -> Cond:
    if isinstance(c, Cond):
        return c
    if isinstance(c, dict):
        op = c.get("op") or (c.get("operator") or {}).get("operation") or "equals"
        return Cond(c.get("left", c.get("leftValue")), op, c.get("right", c.get("rightValue")))
    return Cond(*c)


def js_regex(pattern: str) -> str:
    """JS ``RegExp`` source to Java regex: an unescaped ``$`` matches only at the end."""
    if "[^]" in pattern:
        raise ValueError("JS-only regex syntax [^] is not supported")
    out = []
    i = 0
    in_class = False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if ch == "[":
            in_class = True
        elif ch == "]":
            in_class = False
        if ch == "$" and not in_class:
            out.append("\\z")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def _java_pattern(pattern: str) -> Any:
    """The pattern as Java, which runs it, compiles it."""
    from pyspark import SparkContext

    return SparkContext.getOrCreate()._jvm.java.util.regex.Pattern.compile(js_regex(pattern))


def valid_regex(pattern: str) -> bool:
    try:
        _java_pattern(pattern)
        return True
    except (Py4JJavaError, IllegalArgumentException, ValueError):
        return False


def regex_groups(pattern: str) -> int:
    """Number of capturing groups, named ones included."""
    return _java_pattern(pattern).matcher("").groupCount()


def _present(c: Column, dtype: T.DataType) -> Column:
    """Not null (and not NaN for float columns): the guard that makes a plain
    comparison null-free. ``pred & present`` keeps the comparison itself a
    simple predicate, so Spark can push it into the parquet scan."""
    p = c.isNotNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        p = p & ~F.isnan(c)
    return p


def condition_column(df: DataFrame, cond: Cond | tuple | dict, case_sensitive: bool = True) -> Column:
    """Never-null boolean column for one item-filter condition."""
    cond = _cond(cond)
    lc, ltype, _ = resolve_operand(df, cond.left)
    r = cond.right
    op = cond.op
    lfam = family(ltype)

    if op == "exists":
        return lc.isNotNull() if lfam != "null" else F.lit(False)
    if op == "isEmpty":
        if lfam == "null":
            return F.lit(True)
        if lfam == "string":
            return lc.isNull() | (lc == "")
        return lc.isNull()

    fold = (not case_sensitive) and lfam == "string" and isinstance(r, str)
    l_str = F.lower(lc) if fold else lc
    r_str = r.lower() if fold else r
    present = _present(lc, ltype) if lfam != "null" else F.lit(False)

    def strict_eq() -> Column:
        rfam = lit_family(r)
        if rfam == "null":
            return F.lit(False)  # a present null and a missing value are one null here
        if lfam != rfam:
            return F.lit(False)
        if lfam == "string":
            return (l_str == F.lit(r_str)) & present
        return (lc == F.lit(r)) & present

    if op in ("gt", "gte", "lt", "lte"):
        rn = js_number_literal(r)
        if math.isnan(rn):
            return F.lit(False)
        if lfam == "number":
            ln, guard = lc, present
        else:
            ln = js_number(lc, ltype)
            guard = ln.isNotNull()
        cmp = {"gt": ln > rn, "gte": ln >= rn, "lt": ln < rn, "lte": ln <= rn}[op]
        return cmp & guard
    if op == "equals":
        return strict_eq()
    if op == "notEquals":
        return ~strict_eq()
    if op in ("contains", "notContains", "startsWith", "endsWith", "regex"):
        if lfam != "string":
            return F.lit(False)
        rs = js_string_literal(r_str)
        if op == "contains":
            return l_str.contains(F.lit(rs)) & present
        if op == "notContains":
            return ~l_str.contains(F.lit(rs)) & present
        if op == "startsWith":
            return l_str.startswith(F.lit(rs)) & present
        if op == "endsWith":
            return l_str.endswith(F.lit(rs)) & present
        pat = js_string_literal(r)
        if not valid_regex(pat):
            return F.lit(False)
        jpat = js_regex(pat)
        if not case_sensitive:
            jpat = "(?i)" + jpat
        return F.regexp_like(lc, F.lit(jpat)) & present
    # any other operation name is handled as equals, as in the item filter
    return strict_eq()


def filter_expr(df: DataFrame, conditions: Sequence, combinator: str = "and",
                case_sensitive: bool = True) -> Column:
    conds = [condition_column(df, c, case_sensitive) for c in conditions]
    if not conds:
        return F.lit(True)
    if combinator == "or":
        return reduce(lambda a, b: a | b, conds)
    return reduce(lambda a, b: a & b, conds)


def filter_rows(df: DataFrame, conditions: Sequence, combinator: str = "and",
                case_sensitive: bool = True) -> DataFrame:
    """Item filter: keep rows matching every (``and``) or some (``or``) condition."""
    return df.filter(filter_expr(df, conditions, combinator, case_sensitive))


# --------------------------------------------------------------------------
# condition node (top-level field, loose rules)
# --------------------------------------------------------------------------


def condition_node_expr(df: DataFrame, field: str, op: str, value: Any) -> Column:
    """The condition block: ``eq neq gt lt gte lte contains empty not_empty``."""
    if field in df.columns:
        c = F.col(f"`{field}`")
        dtype = df.schema[field].dataType
    else:
        c, dtype = F.lit(None), T.NullType()
    fam = family(dtype)
    if op in ("eq", "neq"):
        vfam = lit_family(value)
        if vfam == "null":
            res = c.isNull() if fam != "null" else F.lit(True)
        elif fam != vfam:
            res = F.lit(False)
        else:
            res = (c == F.lit(value)) & _present(c, dtype)
        return res if op == "eq" else ~res
    if op in ("gt", "lt", "gte", "lte"):
        rn = js_number_literal(value)
        if math.isnan(rn):
            return F.lit(False)
        if fam == "null":
            return F.lit({"gt": 0.0 > rn, "gte": 0.0 >= rn, "lt": 0.0 < rn, "lte": 0.0 <= rn}[op])
        ln = js_number(c, dtype)
        cmp = {"gt": ln > rn, "gte": ln >= rn, "lt": ln < rn, "lte": ln <= rn}[op]
        zero = {"gt": 0.0 > rn, "gte": 0.0 >= rn, "lt": 0.0 < rn, "lte": 0.0 <= rn}[op]
        # value ?? 0: a null compares as 0; a present value that is not a number is false
        if fam == "number":
            raw = {"gt": c > rn, "gte": c >= rn, "lt": c < rn, "lte": c <= rn}[op]
            return (raw & _present(c, dtype)) | (c.isNull() & F.lit(zero))
        return F.when(c.isNull(), F.lit(zero)).otherwise(F.coalesce(cmp, F.lit(False)))
    if op == "contains":
        s = F.coalesce(js_string(c, dtype), F.lit("")) if fam != "null" else F.lit("")
        return s.contains(F.lit(js_string_literal(value) if value is not None else ""))
    if op == "empty":
        return ~js_truthy(c, dtype) if fam != "null" else F.lit(True)
    if op == "not_empty":
        return js_truthy(c, dtype) if fam != "null" else F.lit(False)
    return F.lit(False)


def where_condition(df: DataFrame, field: str, op: str, value: Any) -> DataFrame:
    return df.filter(condition_node_expr(df, field, op, value))


# --------------------------------------------------------------------------
# search-time metadata filters (all comparisons case-insensitive)
# --------------------------------------------------------------------------


def _meta_value(df: DataFrame, meta_col: str | None, key: str) -> Column:
    """Metadata value as text: a map entry, or a real column of that name."""
    if meta_col is None:
        if key not in df.columns:
            return F.lit(None).cast("string")
        return F.col(f"`{key}`").cast("string")
    return F.try_element_at(F.col(meta_col), F.lit(key))


def _like_escape(pattern: str) -> str:
    return pattern


def meta_condition(v: Column, spec: Any) -> Column:
    """One field's rule: a scalar, or a dict with exactly one operator."""
    lv = F.lower(v)
    if not isinstance(spec, dict):
        return F.coalesce(lv == F.lit(js_string_literal(spec).lower()), F.lit(False))
    if len(spec) != 1:
        raise ValueError("exactly one operator per metadata field")
    (op, arg), = spec.items()
    if op == "$eq":
        return F.coalesce(lv == F.lit(js_string_literal(arg).lower()), F.lit(False))
    if op == "$ne":
        return ~F.coalesce(lv == F.lit(js_string_literal(arg).lower()), F.lit(False))
    if op == "$like":
        return F.coalesce(v.ilike(str(arg)), F.lit(False))
    if op == "$prefix":
        return F.coalesce(lv.startswith(F.lit(str(arg).lower())), F.lit(False))
    if op == "$in":
        vals = list(arg)
        if len(vals) > 100:
            raise ValueError("$in takes at most 100 values; use a semi join on a table")
        return F.coalesce(lv.isin([js_string_literal(x).lower() for x in vals]), F.lit(False))
    if op in ("$gt", "$gte", "$lt", "$lte"):
        if isinstance(arg, (int, float)) and not isinstance(arg, bool):
            lhs = v.try_cast("double")
            lhs = F.when(~F.isnan(lhs), lhs)  # the text NaN is no number, and above none
            rhs = F.lit(float(arg))
        else:
            lhs = lv
            rhs = F.lit(str(arg).lower())
        cmp = {"$gt": lhs > rhs, "$gte": lhs >= rhs, "$lt": lhs < rhs, "$lte": lhs <= rhs}[op]
        return F.coalesce(cmp, F.lit(False))
    if op == "$exists":
        present = F.coalesce(v, F.lit("")) != ""
        return present if arg else ~present
    raise ValueError(f"unknown metadata operator {op}")


def metadata_filter(df: DataFrame, filters: dict, meta_col: str | None = "metadata") -> DataFrame:
    """Keep rows whose metadata matches every field rule."""
    conds = [meta_condition(_meta_value(df, meta_col, k), spec) for k, spec in filters.items()]
    return df.filter(reduce(lambda a, b: a & b, conds, F.lit(True)))


# --------------------------------------------------------------------------
# temporal filters on epoch-ms / timestamp columns
# --------------------------------------------------------------------------


def temporal_filter(df: DataFrame, kind: str, ts_col: str = "event_time",
                    start: Any = None, end: Any = None, entity: str | None = None,
                    as_of: Any = None, tie: str | None = None) -> DataFrame:
    """``before`` / ``after`` / ``between`` (inclusive) / ``as_of`` / ``latest``.

    ``as_of`` and ``latest`` keep the newest version per entity; Spark plans
    ``row_number() = 1`` as a window group limit, so each task keeps one row
    per entity before the shuffle. Among equal times the largest value of the
    column ``tie`` wins, then the largest row by its columns in order, so the
    result never depends on how rows are dealt.
    """
    t = F.col(ts_col)
    if kind == "before":
        return df.filter(t < F.lit(end))
    if kind == "after":
        return df.filter(t > F.lit(start))
    if kind == "between":
        return df.filter(t.between(F.lit(start), F.lit(end)))
    if kind in ("as_of", "latest"):
        if entity is None:
            raise ValueError("entity column required")
        src = df.filter(t <= F.lit(as_of)) if kind == "as_of" else df
        from pyspark.sql import Window

        # maps have no order: their sorted entries do
        rest = [F.array_sort(F.map_entries(F.col(f"`{f.name}`"))) if isinstance(f.dataType, T.MapType) else F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.VariantType)
                else F.col(f"`{f.name}`") for f in src.schema.fields if f.name not in (entity, ts_col, tie)]
        w = Window.partitionBy(entity).orderBy(t.desc(), *([F.col(tie).desc()] if tie else []), *[c.desc() for c in rest])
        return src.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    raise ValueError(kind)


# --------------------------------------------------------------------------
# compound attribute filter, score threshold, job filter, incremental reads
# --------------------------------------------------------------------------

_CMP = {"eq": "==", "ne": "!=", "gt": ">", "gte": ">=", "lt": "<", "lte": "<="}


def compound_expr(df: DataFrame, tree: dict) -> Column:
    """Nested ``{type: and|or, filters: [...]}`` of ``{type, key, value}`` leaves."""
    typ = tree.get("type")
    if typ in ("and", "or"):
        parts = [compound_expr(df, t) for t in tree.get("filters", [])]
        if not parts:
            return F.lit(True)
        return reduce((lambda a, b: a & b) if typ == "and" else (lambda a, b: a | b), parts)
    key, value = tree["key"], tree["value"]
    if key not in df.columns:
        return F.lit(False)
    c = F.col(f"`{key}`")
    if typ == "in":
        return F.coalesce(c.isin(list(value)), F.lit(False))
    if typ == "nin":
        return F.coalesce(~c.isin(list(value)), F.lit(True))
    op = _CMP[typ]
    expr = {"==": c == value, "!=": c != value, ">": c > value, ">=": c >= value,
            "<": c < value, "<=": c <= value}[op]
    return F.coalesce(expr, F.lit(False))


def compound_filter(df: DataFrame, tree: dict) -> DataFrame:
    return df.filter(compound_expr(df, tree))


def min_score(df: DataFrame, x: float, score_col: str = "score") -> DataFrame:
    return df.filter(F.col(score_col) >= F.lit(float(x)))


def job_filter(df: DataFrame, org: str | None = None, bucket: str | None = None,
               status: str | None = None, limit: int | None = None,
               order_by: Iterable[str] = ("id",)) -> DataFrame:
    conds = []
    if org is not None:
        conds.append(F.col("org_id") == org)
    if bucket is not None:
        conds.append(F.col("bucket_id") == bucket)
    if status is not None:
        conds.append(F.col("status") == status)
    out = df.filter(reduce(lambda a, b: a & b, conds, F.lit(True)))
    if limit is not None:
        out = out.orderBy(*order_by).limit(int(limit))
    return out


def after_seq(df: DataFrame, n: int, seq_col: str = "seq") -> DataFrame:
    """Incremental read: rows with ``seq > n`` (pushed into the parquet scan)."""
    return df.filter(F.col(seq_col) > F.lit(n))


def expire_rows(df: DataFrame, days: int, now: Any, col: str = "last_active_at") -> DataFrame:
    """Keep rows active within the last ``days`` days before ``now``."""
    return df.filter(F.col(col) >= F.lit(now) - F.make_dt_interval(F.lit(days)))
