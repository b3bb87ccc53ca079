"""JavaScript value rules on typed Spark columns.

The item operators compare and fold loosely typed values. Spark columns have a
static type, so each rule is decided once at plan time from the column type
and becomes a plain column expression (no UDF):

* ``js_number``  - ``Number(x)``: booleans 0/1, blank text 0, bad text null
  (JS gives NaN; null is used so that every comparison with it is false).
* ``js_string``  - ``String(x)``: integral doubles print without ``.0``.
* ``family``     - type family for strict ``===``: values of different
  families are never equal.
* ``path_col``   - dotted / indexed paths ``a.b``, ``a[0].b``, ``a[].b``.
"""

from __future__ import annotations

import json
import math
import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# type families
# --------------------------------------------------------------------------


def family(dtype: T.DataType | None) -> str:
    if dtype is None or isinstance(dtype, T.NullType):
        return "null"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "date"
    return "object"


def lit_family(v: Any) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "number"
    if isinstance(v, str):
        return "string"
    return "object"


# --------------------------------------------------------------------------
# Number() and String() of driver-side literals
# --------------------------------------------------------------------------


# fixed values: characters that a number's text may be surrounded by
JS_SPACE = " \t\n\x0b\x0c\r\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def js_number_literal(v: Any) -> float:
    """``Number(v)`` for a config value; NaN is returned as ``math.nan``."""
    if v is None:
        return 0.0
    if isinstance(v, bool):
        return 1.0 if v else 0.0
    if isinstance(v, (int, float)):
        return float(v)
    if isinstance(v, str):
        s = v.strip(JS_SPACE)
        if s == "":
            return 0.0
        try:
            if re.fullmatch(r"0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)", s):
                return float(int(s, 0)) if int(s, 0) < 1 << 1024 else math.inf
            if s in ("Infinity", "+Infinity"):
                return math.inf
            if s == "-Infinity":
                return -math.inf
            if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", s):
                return float(s)
        except ValueError:
            pass
        return math.nan
    return math.nan


def js_string_literal(v: Any) -> str:
    """``String(v)`` for a config value."""
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v.is_integer() and abs(v) < 1e21:
            return str(int(v))
        return repr(v)
    if isinstance(v, str):
        return v
    if isinstance(v, list):
        return ",".join("" if x is None else js_string_literal(x) for x in v)
    return "[object Object]"


# --------------------------------------------------------------------------
# column versions
# --------------------------------------------------------------------------


_DIGITS = {4: "0-9a-fA-F", 3: "0-7", 1: "01"}


def _binary_base(t: Column, prefix: str, bits: int) -> Column:
    """Value of ``0x`` / ``0o`` / ``0b`` digits of any number as the nearest
    double; null for other texts. The first 60 bits are taken as a long whose
    last bit also stands for any bit set behind them, which rounds right."""
    digits = F.regexp_replace(F.substring(t, 3, 1 << 30), "^0+", "")
    take = 60 // bits
    head = F.conv(F.substring(digits, 1, take), 1 << bits, 10).cast("long")
    more = F.substring(digits, take + 1, 1 << 30).rlike("[^0]") & (head % 2 == 0)
    value = (head + F.when(more, 1).otherwise(0)).cast("double") * F.pow(F.lit(2.0), bits * F.greatest(F.length(digits) - take, F.lit(0)))
    return F.when(t.rlike(rf"^0[{prefix}][{_DIGITS[bits]}]+$"), F.when(digits == "", F.lit(0.0)).otherwise(value))


def js_number(c: Column, dtype: T.DataType) -> Column:
    """``Number(c)`` as a double column; null where JS gives NaN or the value is missing."""
    fam = family(dtype)
    if fam == "number":
        d = c.cast("double")
        return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)
    if fam == "boolean":
        return F.when(c, F.lit(1.0)).when(~c, F.lit(0.0))
    if fam == "string":
        t = F.trim(c, F.lit(JS_SPACE))
        number = F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double"))
        for digits, bits in (("xX", 4), ("oO", 3), ("bB", 1)):  # 0x1f, 0o17, 0b11
            number = F.coalesce(number, _binary_base(t, digits, bits))
        number = F.coalesce(number, F.when(t.isin("Infinity", "+Infinity", "-Infinity"), t.try_cast("double")))
        return F.when(t == "", F.lit(0.0)).otherwise(number)
    if fam == "date":
        return F.unix_millis(c.cast("timestamp")).cast("double")
    return F.lit(None).cast("double")


def js_string(c: Column, dtype: T.DataType) -> Column:
    """``String(c)``; null stays null so callers choose the missing rule."""
    fam = family(dtype)
    if fam == "string":
        return c
    if fam == "boolean":
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    if fam == "number":
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
            return c.cast("string")
        d = c.cast("double")
        return (
            F.when(F.isnan(d), F.lit("NaN"))
            .when((d == F.floor(d)) & (F.abs(d) < F.lit(1e18)), d.cast("long").cast("string"))
            .otherwise(d.cast("string"))
        )
    if fam == "date":
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(c, lambda x: x.cast("string")), ",", "")
    return F.to_json(c)


def js_truthy(c: Column, dtype: T.DataType) -> Column:
    """``Boolean(c)``: false for null, "", 0, NaN and false; objects are truthy."""
    fam = family(dtype)
    if fam == "string":
        return F.coalesce(c != "", F.lit(False))
    if fam == "number":
        d = c.cast("double")
        return F.coalesce((d != 0) & ~F.isnan(d), F.lit(False))
    if fam == "boolean":
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


# --------------------------------------------------------------------------
# paths
# --------------------------------------------------------------------------

_SEG = re.compile(r"([^.\[\]]+)|\[(\d*)\]")


def parse_path(path: str) -> list[tuple[str, Any]]:
    """``a.b[0].c[]`` -> [("key","a"),("key","b"),("idx",0),("key","c"),("all",None)]."""
    out: list[tuple[str, Any]] = []
    for m in _SEG.finditer(path):
        if m.group(1) is not None:
            out.append(("key", m.group(1)))
        elif m.group(2) == "":
            out.append(("all", None))
        else:
            out.append(("idx", int(m.group(2))))
    return out


def _step(c: Column, dtype: T.DataType, seg: tuple[str, Any]) -> tuple[Column, T.DataType] | None:
    kind, arg = seg
    if kind == "key":
        if isinstance(dtype, T.StructType):
            if arg not in dtype.fieldNames():
                return None
            return c.getField(arg), dtype[arg].dataType
        if isinstance(dtype, T.MapType):
            return F.try_element_at(c, F.lit(arg)), dtype.valueType
        if isinstance(dtype, T.VariantType):
            return F.try_variant_get(c, f"$.{arg}", "variant"), dtype
        return None
    if kind == "idx":
        if isinstance(dtype, T.ArrayType):
            return F.get(c, F.lit(arg)), dtype.elementType
        if isinstance(dtype, T.VariantType):
            return F.try_variant_get(c, f"$[{arg}]", "variant"), dtype
        return None
    return None


def path_col(df_or_schema: DataFrame | T.StructType, path: str) -> tuple[Column, T.DataType]:
    """Column for a path; a missing path gives a null literal (JS ``undefined``).

    ``[]`` maps the rest of the path over an array, flattens one level when the
    rest yields arrays, and drops nulls (the reference's select rule).
    """
    schema = df_or_schema.schema if isinstance(df_or_schema, DataFrame) else df_or_schema
    segs = parse_path(path)
    if not segs or segs[0][0] != "key" or segs[0][1] not in schema.fieldNames():
        return F.lit(None), T.NullType()
    c: Column = F.col(f"`{segs[0][1]}`")
    dtype = schema[segs[0][1]].dataType
    rest = segs[1:]
    return _walk(c, dtype, rest)


def _walk(c: Column, dtype: T.DataType, segs: list[tuple[str, Any]]) -> tuple[Column, T.DataType]:
    for i, seg in enumerate(segs):
        if seg[0] == "all":
            if not isinstance(dtype, T.ArrayType):
                return F.lit(None), T.NullType()
            tail = segs[i + 1:]
            probe = _walk(F.lit(None), dtype.elementType, tail)[1]
            if isinstance(probe, T.NullType):
                return F.lit(None), T.NullType()
            mapped = F.transform(c, lambda x: _walk(x, dtype.elementType, tail)[0])
            if isinstance(probe, T.ArrayType):
                mapped = F.flatten(F.filter(mapped, lambda x: x.isNotNull()))
                return F.filter(mapped, lambda x: x.isNotNull()), probe
            return F.filter(mapped, lambda x: x.isNotNull()), T.ArrayType(probe)
        nxt = _step(c, dtype, seg)
        if nxt is None:
            return F.lit(None), T.NullType()
        c, dtype = nxt
    return c, dtype


def resolve_operand(df: DataFrame, value: Any) -> tuple[Column, T.DataType, bool]:
    """Left side of a filter condition.

    ``={{$json.a.b}}`` is a path, a bare name is a column when one exists,
    anything else is a literal. Returns (column, type, is_literal).
    """
    if isinstance(value, str) and value.startswith("={{") and value.endswith("}}"):
        p = value[3:-2].strip()
        if p.startswith("$json."):
            p = p[len("$json."):]
        c, t = path_col(df, p)
        return c, t, False
    if isinstance(value, str) and not value.startswith("=") and value in df.columns:
        return F.col(f"`{value}`"), df.schema[value].dataType, False
    return literal(value)


def literal(v: Any) -> tuple[Column, T.DataType, bool]:
    fam = lit_family(v)
    if fam == "null":
        return F.lit(None), T.NullType(), True
    if fam == "boolean":
        return F.lit(v), T.BooleanType(), True
    if fam == "number":
        return F.lit(float(v)) if isinstance(v, float) else F.lit(v), (
            T.DoubleType() if isinstance(v, float) else T.LongType()), True
    if fam == "string":
        return F.lit(v), T.StringType(), True
    return F.lit(json.dumps(v)), T.StringType(), True


def dtype_of(df: DataFrame, c: Column) -> T.DataType:
    """Analysed type of an expression over ``df`` (analysis only, no job)."""
    return df.select(c.alias("_t")).schema["_t"].dataType
