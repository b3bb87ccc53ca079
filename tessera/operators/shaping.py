"""Projections and column shaping: set, select paths, flatten, parse, answer
formatting, templates, variables, defaults, citations, key case, schemas.

Configuration (templates, field lists, JSON constants) is parsed once on the
driver and becomes literals and column expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsvalues import family, js_number_literal, js_string, path_col


def json_literal(value: Any) -> Column:
    """A typed literal for a parsed JSON value (objects become structs)."""
    if value is None:
        return F.lit(None)
    if isinstance(value, (bool, int, float, str)):
        return F.lit(value)
    text = json.dumps(value)
    return F.from_json(F.lit(text), F.schema_of_json(F.lit(text)))


# --------------------------------------------------------------------------
# set
# --------------------------------------------------------------------------


def set_fields(df: DataFrame, fields: Sequence[tuple[str, str, Any]]) -> DataFrame:
    """Set block, manual mode: ``(name, type, value)``.

    ``number`` text goes through ``Number()``; ``boolean`` text is true only
    for ``"true"``; ``object``/``array`` text is parsed, left as text when bad.
    """
    cols: dict[str, Column] = {}
    for name, typ, value in fields:
        v = value
        if typ == "number" and isinstance(v, str):
            v = js_number_literal(v)
        elif typ == "boolean" and isinstance(v, str):
            v = v == "true"
        elif typ in ("object", "array") and isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                pass
        cols[name] = json_literal(v)
    return df.withColumns(cols)


def set_json(df: DataFrame, text: str) -> DataFrame:
    """Set block, JSON mode: merge one object into every row; bad JSON = no change."""
    try:
        obj = json.loads(text)
    except ValueError:
        return df
    if not isinstance(obj, dict):
        return df
    return df.withColumns({k: json_literal(v) for k, v in obj.items()})


# --------------------------------------------------------------------------
# select / rename / flatten
# --------------------------------------------------------------------------


def default_name(path: str) -> str:
    return path.replace("[]", "").replace(".", "_")


def _select_path(df: DataFrame, path: str) -> tuple[Column, T.DataType]:
    # ``a[]`` with nothing after it returns the list itself
    if path.endswith("[]") and "[]" not in path[:-2]:
        return path_col(df, path[:-2])
    return path_col(df, path)


def select_paths(df: DataFrame, fields: Sequence[str], rename: dict[str, str] | None = None,
                 flatten: bool = False) -> DataFrame:
    """Field selector: pick paths (``a.b``, ``a[0].b``, ``a[].b``); default
    output names drop ``[]`` and turn dots into ``_``; ``rename`` wins."""
    rename = rename or {}
    out = []
    for p in fields:
        c, _ = _select_path(df, p)
        out.append(c.alias(rename.get(p, default_name(p))))
    res = df.select(*out)
    return flatten_struct(res) if flatten else res


def flatten_struct(df: DataFrame) -> DataFrame:
    """One level: struct column ``k`` with field ``s`` becomes ``k_s``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"`{f.name}`").getField(s.name).alias(f"{f.name}_{s.name}")
                     for s in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def columns_of(df: DataFrame) -> DataFrame:
    """The list-valued selected fields, reported again as columns."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields
                       if isinstance(f.dataType, T.ArrayType)])


def parse_json(df: DataFrame, col: str, schema: T.StructType | str | None = None,
               out: str | None = None) -> DataFrame:
    """Text to structured value; bad JSON gives an empty object.

    With a schema: ``from_json`` (PERMISSIVE: a bad row is all-null fields).
    Without: a ``VARIANT`` from ``try_parse_json``, ``{}`` when bad.
    """
    target = out or col
    if schema is not None:
        return df.withColumn(target, F.from_json(F.col(col), schema))
    return df.withColumn(target, F.coalesce(F.try_parse_json(F.col(col)), F.parse_json(F.lit("{}"))))


# --------------------------------------------------------------------------
# answer formatting
# --------------------------------------------------------------------------


def _num_text(c: Column) -> Column:
    return js_string(c, T.DoubleType())


def format_answer(df: DataFrame, fmt: str = "text", include_sources: bool = True,
                  max_length: int | None = None, text_col: str = "text",
                  results_col: str = "results") -> DataFrame:
    """Answer block: cut text to ``max_length`` + ``...``; sources
    ``id, score, source, snippet(200)``; text / markdown list / JSON."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if max_length:
        text = F.when(F.char_length(text) > max_length,
                      F.concat(F.substring(text, 1, max_length), F.lit("..."))).otherwise(text)
    rtype = df.schema[results_col].dataType if results_col in df.columns else None
    if include_sources and rtype is not None:
        et = rtype.elementType
        names = et.fieldNames()
        has_meta = "metadata" in names

        def src(r: Column) -> Column:
            meta_src = F.try_element_at(r["metadata"], F.lit("source")) if has_meta else F.lit(None)
            meta_txt = F.try_element_at(r["metadata"], F.lit("text")) if has_meta else F.lit(None)
            return F.struct(
                F.coalesce(r["id"].cast("string"), F.lit("")).alias("id"),
                F.coalesce(r["score"].cast("double"), F.lit(0.0)).alias("score"),
                F.when(F.coalesce(meta_src, F.lit("")) != "", meta_src).alias("source"),
                F.when(F.coalesce(meta_txt, F.lit("")) != "", F.substring(meta_txt, 1, 200)).alias("snippet"))
        sources = F.transform(F.coalesce(F.col(results_col), F.array()), src)
    else:
        sources = F.array().cast("array<struct<id:string,score:double,source:string,snippet:string>>")
    d = df.withColumn("_text", text).withColumn("sources", sources)
    if fmt == "markdown":
        lines = F.array_join(F.transform("sources", lambda s: F.concat(
            F.lit("- "), F.coalesce(s["source"], s["id"]), F.lit(" (score: "), _num_text(s["score"]),
            F.lit(")"))), "\n")
        answer = F.when(F.size("sources") > 0, F.concat(
            F.col("_text"), F.lit("\n\n---\n**Sources:**\n"), lines)).otherwise(F.col("_text"))
    elif fmt == "json":
        answer = F.to_json(F.struct(F.col("_text").alias("text"), F.col("sources")))
    else:
        answer = F.col("_text")
    return d.withColumn("answer", answer).withColumn("format", F.lit(fmt)).drop("_text")


# --------------------------------------------------------------------------
# templates and variables
# --------------------------------------------------------------------------

_VAR = re.compile(r"\{\{(.+?)\}\}")


def _format_item(v: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        names = dtype.fieldNames()
        text = v["text"].cast("string") if "text" in names else F.lit(None)
        if "metadata" in names:
            mt = dtype["metadata"].dataType
            if isinstance(mt, T.MapType):
                text = F.coalesce(text, F.try_element_at(v["metadata"], F.lit("text")))
            elif isinstance(mt, T.StructType) and "text" in mt.fieldNames():
                text = F.coalesce(text, v["metadata"]["text"].cast("string"))
        text = F.coalesce(text, F.lit(""))
        if "score" in names:
            st = dtype["score"].dataType
            sc = js_string(v["score"], st)
            return F.when(sc.isNotNull() & (sc != ""), F.concat(text, F.lit(" (score: "), sc, F.lit(")"))).otherwise(text)
        return text
    return F.coalesce(js_string(v, dtype), F.lit("null"))


def _value_text(df: DataFrame, name: str, variables: dict[str, Any]) -> Column:
    var = variables.get(name, "")
    if isinstance(var, list):
        var_text = "\n".join(f"- {x}" for x in var)
    elif isinstance(var, bool):
        var_text = "true" if var else "false"
    elif var is None:
        var_text = ""
    else:
        var_text = str(var)
    if name not in df.columns:
        return F.lit(var_text)
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, T.ArrayType):
        et = dtype.elementType
        txt = F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), _format_item(x, et))), "\n")
    else:
        txt = js_string(c, dtype)
    return F.coalesce(txt, F.lit(var_text))


def compile_template(df: DataFrame, template: str, variables: dict[str, Any] | None = None) -> Column:
    """``{{name}}`` from the row, else from ``variables``, else ``""``."""
    variables = variables or {}
    parts: list[Column] = []
    pos = 0
    for m in _VAR.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(_value_text(df, m.group(1).strip(), variables))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    if not parts:
        return F.lit("")
    return F.concat(*parts)


def render_template(df: DataFrame, template: str = "{{query}}", system: str = "",
                    variables: dict[str, Any] | None = None) -> DataFrame:
    """Prompt template block: adds ``prompt`` and ``system_prompt``."""
    return df.withColumn("prompt", compile_template(df, template, variables)).withColumn(
        "system_prompt", compile_template(df, system, variables))


def with_variables(df: DataFrame, variables: dict[str, Any] | None = None,
                   keys: Sequence[str] | None = None, mode: str = "set_get") -> DataFrame:
    """Variable block. ``set`` stores config values and the row's fields;
    ``get`` returns the named keys (row first, then config) or all of them."""
    variables = variables or {}
    if mode == "set":
        return df.select()
    merged: dict[str, Column] = {k: json_literal(v) for k, v in variables.items()} if mode != "get" else {}
    if mode == "set_get":
        for c in df.columns:
            merged[c] = F.col(f"`{c}`")
    else:
        merged.update({k: json_literal(v) for k, v in variables.items()})
        for c in df.columns:
            merged[c] = F.col(f"`{c}`")
    if keys:
        return df.select(*[(merged[k] if k in merged else F.lit(None)).alias(k) for k in keys])
    return df.select(*[v.alias(k) for k, v in merged.items()])


def default_columns(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """Config value used only where the row has none."""
    cols = {}
    for k, v in defaults.items():
        cols[k] = F.coalesce(F.col(f"`{k}`"), F.lit(v)) if k in df.columns else F.lit(v)
    return df.withColumns(cols)


def project_fields(df: DataFrame, include: Sequence[str] | None = None,
                   exclude: Sequence[str] | None = None) -> DataFrame:
    """Response whitelist (dotted paths) or, when none is given, blacklist."""
    if include:
        return df.select(*[path_col(df, p)[0].alias(p) for p in include])
    if not exclude:
        return df
    out = df
    for p in exclude:
        if "." in p:
            top, rest = p.split(".", 1)
            if top in out.columns and isinstance(out.schema[top].dataType, T.StructType):
                out = out.withColumn(top, F.col(top).dropFields(rest))
        elif p in out.columns:
            out = out.drop(p)
    return out


_CITE = re.compile(r"\{(\w+)\}")


def format_citation(df: DataFrame, fmt: str = "[{title}:{page}]", meta_col: str = "metadata",
                    out: str = "citation") -> DataFrame:
    """Citation text: each ``{name}`` from metadata first, then from a column."""
    parts: list[Column] = []
    pos = 0
    has_meta = meta_col in df.columns
    for m in _CITE.finditer(fmt):
        if m.start() > pos:
            parts.append(F.lit(fmt[pos:m.start()]))
        name = m.group(1)
        meta = F.try_element_at(F.col(meta_col), F.lit(name)) if has_meta else F.lit(None)
        colv = js_string(F.col(name), df.schema[name].dataType) if name in df.columns else F.lit(None)
        parts.append(F.coalesce(meta, colv, F.lit("")))
        pos = m.end()
    if pos < len(fmt):
        parts.append(F.lit(fmt[pos:]))
    return df.withColumn(out, F.concat(*parts) if parts else F.lit(""))


def to_snake(name: str) -> str:
    return re.sub(r"[A-Z]", lambda m: "_" + m.group(0).lower(), name)


def to_camel(name: str) -> str:
    return re.sub(r"_([a-z])", lambda m: m.group(1).upper(), name)


def rename_case(df: DataFrame, to: str = "camel") -> DataFrame:
    """Top-level column names snake <-> camel (nested names kept)."""
    fn = to_camel if to == "camel" else to_snake
    return df.toDF(*[fn(c) for c in df.columns])


# --------------------------------------------------------------------------
# JSON-Schema subset
# --------------------------------------------------------------------------

_JS_TYPES = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(),
             "boolean": T.BooleanType()}


def schema_to_struct(schema: dict) -> T.DataType:
    t = schema.get("type", "string")
    if t == "object":
        props = schema.get("properties", {})
        return T.StructType([T.StructField(k, schema_to_struct(v), True) for k, v in props.items()])
    if t == "array":
        return T.ArrayType(schema_to_struct(schema.get("items", {"type": "string"})))
    return _JS_TYPES.get(t, T.StringType())


def apply_json_schema(df: DataFrame, col: str, schema: dict, out: str = "value") -> DataFrame:
    """Parse text by a JSON-Schema subset; ``required`` fields that are
    missing are listed in ``violations`` (checked, not enforced)."""
    st = schema_to_struct(schema)
    d = df.withColumn(out, F.from_json(F.col(col), st))
    req = schema.get("required", []) if schema.get("type") == "object" else []
    checks = [F.when(F.col(out).isNull() | F.col(out).getField(r).isNull(), F.lit(r)) for r in req]
    viol = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return d.withColumn("violations", viol)
