"""Scalar functions: dates, casts, JSON paths, names, tokens, lines.

All are column expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: date-format tokens of the datetime block, in replacement order
DT_TOKENS = ("yyyy", "MM", "dd", "HH", "mm", "ss")

# fixed values: tool-name rule of the tool registry
TOOL_NAME_PATTERN = r"^[a-zA-Z_][a-zA-Z0-9_]*$"

# fixed values: milliseconds per datetime unit; any other unit counts as days
UNIT_MS = {"seconds": 1000, "minutes": 60_000, "hours": 3_600_000, "days": 86_400_000}


def dt_pattern(pattern: str) -> str:
    """Datetime-block pattern to a Spark ``date_format`` pattern.

    Only ``yyyy MM dd HH mm ss`` are tokens; every other character is literal
    text, so it is quoted for Spark.
    """
    out: list[str] = []
    lit: list[str] = []

    def flush():
        if lit:
            s = "".join(lit).replace("'", "''")
            out.append(f"'{s}'")
            lit.clear()

    i = 0
    while i < len(pattern):
        for tok in DT_TOKENS:
            if pattern.startswith(tok, i):
                flush()
                out.append(tok)
                i += len(tok)
                break
        else:
            lit.append(pattern[i])
            i += 1
    flush()
    return "".join(out)


def dt_format(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Format a timestamp (UTC wall clock for ``timestamp_ntz``)."""
    return F.date_format(ts, dt_pattern(pattern))


def dt_now(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.current_timestamp(), dt_pattern(pattern))


def dt_shift(ts: Column, amount: float, unit: str = "days", sign: int = 1) -> Column:
    """Add (sign=1) or subtract (sign=-1) a fixed number of ms; days are 24 h."""
    ms = UNIT_MS.get(unit, UNIT_MS["days"])
    micros = int(round(sign * amount * ms * 1000))
    return ts + F.make_dt_interval(secs=F.lit(micros / 1e6))


def dt_diff(start: Column, end: Column) -> Column:
    """``end - start`` in seconds with fraction."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def dt_parse(c: Column, is_millis: bool = False) -> Column:
    """ISO text or epoch milliseconds to a timestamp; unparsable gives null."""
    if is_millis:
        return F.timestamp_millis(c.cast("long"))
    return F.try_to_timestamp(c)


def cast_bool(c: Column, style: str = "set") -> Column:
    """``set``: only ``"true"``; ``extract``: true / 1 / yes in any case."""
    if style == "set":
        return c == F.lit("true")
    return F.lower(F.trim(c)).isin("true", "1", "yes")


def lead_number(c: Column, kind: str = "float") -> Column:
    """``parseInt`` / ``parseFloat``: the leading number of a text, else null."""
    if kind == "int":
        return F.regexp_substr(c, F.lit(r"^\s*[+-]?\d+")).try_cast("long")
    return F.regexp_substr(c, F.lit(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")).try_cast("double")


def json_path(c: Column, path: str, type_: str = "string") -> Column:
    """Value at ``a.b``, ``a[0]``, ``a[].b`` in JSON text.

    Plain paths use the variant reader (typed, null when absent); ``[]``
    paths use ``get_json_object`` with ``[*]`` and return JSON text.
    """
    jp = "$"
    for seg in re.finditer(r"([^.\[\]]+)|\[(\d*)\]", path):
        if seg.group(1) is not None:
            jp += f".{seg.group(1)}"
        elif seg.group(2) == "":
            jp += "[*]"
        else:
            jp += f"[{seg.group(2)}]"
    if "[*]" in jp:
        return F.get_json_object(c, jp)
    return F.try_variant_get(F.try_parse_json(c), jp, type_)


def slug(c: Column, fallback: str = "node") -> Column:
    """Lowercase, runs of non ``[a-z0-9]`` to ``_``, trimmed of ``_``."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(fallback)).otherwise(s)


def slugify(df: DataFrame, name: str, order_by: Sequence[str], out: str = "slug",
            fallback: str = "node") -> DataFrame:
    """Unique ids from names: repeats of a slug get ``_1``, ``_2`` in order.

    The repeat number is the row's position among equal slugs, computed with
    the skew-safe ``positions`` (a very common slug is split across tasks).
    A generated ``x_1`` that equals another row's own slug is not re-numbered.
    """
    from tessera.operators.ordering import positions

    base = df.withColumn("_base", slug(F.col(name), fallback))
    p = positions(base, ["_base"], order_by, name="_n")
    return p.withColumn(out, F.when(F.col("_n") == 0, F.col("_base")).otherwise(
        F.concat(F.col("_base"), F.lit("_"), F.col("_n").cast("string")))).drop("_base", "_n")


def title_case(c: Column) -> Column:
    """``snake_case`` to ``Snake Case``: underscores to spaces, each word
    capitalised (the rest of the word is kept as is)."""
    spaced = F.regexp_replace(c, "_", " ")
    words = F.split(spaced, "(?<=\\W)|(?=\\W)")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                             F.substring(w, 2, 1 << 30))), "")


def valid_name(c: Column) -> Column:
    return F.regexp_like(c, F.lit(TOOL_NAME_PATTERN))


def token_estimate(c: Column) -> Column:
    """Tokens of a text: ``ceil(chars / 4)`` (our estimate)."""
    return F.ceil(F.char_length(F.coalesce(c, F.lit(""))) / F.lit(4.0)).cast("long")


def parse_args(c: Column) -> tuple[Column, Column]:
    """Tool arguments: parsed value and an error text when the JSON is bad."""
    v = F.try_parse_json(c)
    err = F.when(c.isNotNull() & v.isNull(), F.concat(
        F.lit("Invalid JSON in tool arguments. Raw: "), F.substring(c, 1, 200)))
    return v, err


def keyword_tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != "")


def query_lines(c: Column, n: int) -> Column:
    """Reply text to a query list: split lines, trim, drop empty, first ``n``."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(lines, 1, n)


def running_label(df: DataFrame, partition: Sequence[str], order: Sequence[str], marker: str,
                  out: str) -> DataFrame:
    """Carry the last non-null ``marker`` forward within a partition."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(F.col(marker), ignorenulls=True).over(w))
