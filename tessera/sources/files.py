"""Sources and sinks: file loading, collection ingest, metadata checks,
upserts and deletes, vector imports, landing-folder streams, front-matter
scans and answer export.

Everything reads and writes through Spark's data sources; HTTP calls of the
reference (uploads, feeds, webhooks) become files landing in a folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ----------------------------------------------------------------- S1 load


def load_documents(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None,
                   **options: Any) -> DataFrame:
    """Documents from files: ``parquet``, ``json``, ``csv``, ``text`` (one
    row per file, whole text) or ``binary`` (bytes + path for decoders)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "parquet":
        return r.options(**options).parquet(path)
    if fmt == "json":
        return r.options(**options).json(path)
    if fmt == "csv":
        return r.options(header=True, **options).csv(path)
    if fmt == "text":
        return spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name()) \
            .withColumnRenamed("value", "text")
    if fmt == "binary":
        return spark.read.format("binaryFile").options(**options).load(path)
    raise ValueError(f"unknown format {fmt}")


# ------------------------------------------------------------- S2 ingest

# fixed values: reserved metadata keys named by the upload contract (a partial list there)
RESERVED_KEYS = ("document_id", "chunk_id", "bucket_id", "text")
MAX_KEYS = 32
MAX_KEY_LEN = 64
MAX_VALUE_LEN = 512
MAX_JSON_BYTES = 4096
KEY_PATTERN = r"^[A-Za-z0-9_.-]+$"


def ingest_upload(df: DataFrame, bucket: str, collection: str | Column | None = None,
                  metadata: dict[str, Any] | None = None, meta_col: str = "metadata") -> DataFrame:
    """Stamp every row with the bucket, the collection (a name, or a column that
    holds each row's) and the per-upload metadata (values coerced to text,
    merged over the row's own metadata)."""
    meta = {k: (json.dumps(v) if isinstance(v, bool) else str(v)) for k, v in (metadata or {}).items()}
    if isinstance(metadata, dict):
        for k, v in metadata.items():
            if isinstance(v, bool):
                meta[k] = "true" if v else "false"
    stamp = F.create_map(*[x for k, v in meta.items() for x in (F.lit(k), F.lit(v))]) if meta \
        else F.create_map().cast("map<string,string>")
    out = df.withColumn("bucket", F.lit(bucket)).withColumn("collection", collection if isinstance(collection, Column) else F.lit(collection))
    if meta_col in df.columns:
        merged = F.map_from_entries(F.array_union(
            F.filter(F.map_entries(F.col(meta_col)), lambda e: ~F.array_contains(F.map_keys(stamp), e["key"])),
            F.map_entries(stamp)))
        return out.withColumn(meta_col, merged)
    return out.withColumn(meta_col, stamp)


def write_collection(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write chunks partitioned by bucket and collection (partition pruning
    on later searches)."""
    df.write.mode(mode).partitionBy("bucket", "collection").parquet(path)


def validate_metadata(df: DataFrame, col: str = "metadata") -> DataFrame:
    """Flag metadata maps that break the upload limits; ``errors`` lists them."""
    m = F.col(col)
    keys = F.map_keys(m)
    vals = F.map_values(m)
    checks = [
        F.when(F.size(keys) > MAX_KEYS, F.lit(f"more than {MAX_KEYS} keys")),
        F.when(F.exists(keys, lambda k: ~F.regexp_like(k, F.lit(KEY_PATTERN))), F.lit("bad key characters")),
        F.when(F.exists(keys, lambda k: F.char_length(k) > MAX_KEY_LEN), F.lit(f"key longer than {MAX_KEY_LEN}")),
        F.when(F.exists(vals, lambda v: F.char_length(v) > MAX_VALUE_LEN), F.lit(f"value longer than {MAX_VALUE_LEN}")),
        F.when(F.octet_length(F.to_json(m)) > MAX_JSON_BYTES, F.lit(f"JSON above {MAX_JSON_BYTES} bytes")),
        F.when(F.exists(keys, lambda k: k.isin(list(RESERVED_KEYS))), F.lit("reserved key")),
    ]
    errs = F.array_compact(F.array(*checks))
    return df.withColumn("errors", F.when(m.isNull(), F.array().cast("array<string>")).otherwise(errs)) \
        .withColumn("valid", F.size("errors") == 0)


# ----------------------------------------------------- S4 / S5 upsert, delete


def upsert(target: DataFrame, updates: DataFrame, key: str | Sequence[str], version_col: str | None = None,
           prefer_col: str | None = None) -> DataFrame:
    """New rows replace stored rows with the same key.

    Without ``version_col`` the update always wins; with it the higher
    version wins. ``prefer_col`` (e.g. ``has_document``) breaks ties so that
    rows carrying documents win over bare vectors. One partial ``max_by`` per
    key: a key with many versions is reduced map-side.
    """
    key = [key] if isinstance(key, str) else list(key)
    t = target.withColumn("_src", F.lit(0))
    u = updates.withColumn("_src", F.lit(1))
    allc = t.unionByName(u, allowMissingColumns=True)
    order = []
    if prefer_col:
        order.append(F.coalesce(F.col(prefer_col).cast("int"), F.lit(0)))
    if version_col:
        order.append(F.col(version_col))
    order.append(F.col("_src"))
    row = F.struct(*[F.col(f"`{c}`") for c in allc.columns if c != "_src"])
    g = allc.groupBy(*key).agg(F.max_by(row, F.struct(*order)).alias("_r"))
    return g.select("_r.*")


def delete_by_key(target: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return target.join(ids.select(key).distinct(), on=key, how="left_anti")


# --------------------------------------------------------- S9 vector import


def parse_vector_text(c: Column) -> Column:
    """pgvector text ``[0.1,0.2,...]`` to ``array<double>``."""
    inner = F.regexp_replace(F.trim(c), r"^\[|\]$", "")
    return F.transform(F.split(inner, r"\s*,\s*"), lambda x: x.try_cast("double"))


def read_vectors(spark: SparkSession, kind: str, options: dict[str, Any]) -> DataFrame:
    """Vectors from a store export into ``(id, vector, metadata)``.

    ``pgvector``: a JDBC table (``url``, ``dbtable``, ``id``/``vector``
    column names) with the vector as text; ``parquet`` / ``json``: exports
    (chroma, pinecone, weaviate dumps) with the column names given.
    """
    idc, vc, mc = options.get("id", "id"), options.get("vector", "vector"), options.get("metadata")
    if kind == "pgvector":
        src = spark.read.format("jdbc").options(**{k: v for k, v in options.items()
                                                   if k not in ("id", "vector", "metadata")}).load()
        vec = parse_vector_text(F.col(vc).cast("string"))
    elif kind in ("parquet", "json"):
        src = spark.read.format(kind).load(options["path"])
        dt = src.schema[vc].dataType
        vec = parse_vector_text(F.col(vc)) if isinstance(dt, T.StringType) else F.col(vc).cast("array<double>")
    else:
        raise ValueError(kind)
    meta = F.col(mc) if mc else F.create_map().cast("map<string,string>")
    return src.select(F.col(idc).cast("string").alias("id"), vec.alias("vector"), meta.alias("metadata"))


def vectors_from_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pgvector path on an already loaded table."""
    return df.select(F.col(id_col).cast("string").alias("id"), parse_vector_text(F.col(text_col)).alias("vector"))


# fixed values: fields of a JSON line in each store's export
_EXPORT_FIELDS = {
    "pinecone": "id string, values array<double>, metadata map<string,string>",
    "weaviate": "id string, vector array<double>, properties map<string,string>",
    "chroma": "ids array<string>, embeddings array<array<double>>, metadatas array<map<string,string>>",
}
LAYOUTS = ("pgvector", *_EXPORT_FIELDS)


def import_vectors(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Vectors of an exported store: ``(id, vector, metadata, error)``.

    Every layout is lines of text, so Spark reads it in file ranges, one task
    each, whatever the size of a file:

    * ``pgvector``: ``id <tab> [x,y,...] <tab> metadata as JSON`` (the last may be missing);
    * ``pinecone``: ``{"id", "values", "metadata"}``;
    * ``weaviate``: ``{"id", "vector", "properties"}``;
    * ``chroma``: ``{"ids", "embeddings", "metadatas"}``, lists of equal length, a batch a line.

    A line, or an entry of a batch, without an id or a whole vector of numbers
    comes back with ``error`` and without a vector; nothing is dropped but
    empty lines. Metadata values are text.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout}")
    lines = spark.read.text(path).where(F.trim("value") != "")
    none = F.create_map().cast("map<string,string>")
    if layout == "pgvector":
        part = F.split("value", "\t", 3)
        meta = F.from_json(F.try_element_at(part, F.lit(3)), "map<string,string>")
        rows = lines.select(F.nullif(part[0], F.lit("")).alias("id"), parse_vector_text(F.try_element_at(part, F.lit(2))).alias("vector"), meta.alias("metadata"))
    else:
        r = lines.select(F.from_json("value", _EXPORT_FIELDS[layout]).alias("r"))
        if layout == "chroma":
            whole = F.coalesce(F.size("r.ids") == F.size("r.embeddings"), F.lit(False))
            entry = F.transform(F.when(whole, F.col("r.ids")).otherwise(F.array(F.lit(None).cast("string"))), lambda x, i: F.struct(
                x.alias("id"), F.get("r.embeddings", i).alias("vector"), F.get("r.metadatas", i).alias("metadata")))
            rows = r.select(F.explode(entry).alias("e")).select("e.*")
        else:
            vector, meta = ("values", "metadata") if layout == "pinecone" else ("vector", "properties")
            rows = r.select(F.col("r.id").alias("id"), F.col(f"r.{vector}").alias("vector"), F.col(f"r.{meta}").alias("metadata"))
    usable = F.coalesce((F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)), F.lit(False))
    error = F.when(F.col("id").isNull(), "no id").when(~usable, "no vector of numbers")
    return rows.select("id", F.when(error.isNull(), F.col("vector")).alias("vector"), F.coalesce("metadata", none).alias("metadata"), error.alias("error"))


# ----------------------------------------------------------- S14 front matter

LIST_KEYS = ("allowed-tools", "blocked-tools", "procedures", "constraints")
NAME_PATTERN = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def scan_frontmatter(df: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Markdown rule files: front block between ``---`` lines (CRLF allowed)
    and body; ``key: value`` lines (``#`` comments and lines without ``:``
    skipped), the four list keys split on whitespace. Flags a bad name
    (kebab-case, 1-64), a bad description (1-1024), a missing block and
    names used by more than one file."""
    rx = r"(?s)^---\r?\n(.*?)\r?\n---\r?\n?(.*)$"
    has = F.regexp_like(F.col(text), F.lit(rx))
    front = F.when(has, F.regexp_extract(F.col(text), rx, 1))
    body = F.when(has, F.regexp_extract(F.col(text), rx, 2))
    lines = F.filter(F.transform(F.split(front, r"\r?\n"), lambda l: F.trim(l)),
                     lambda l: (l != "") & ~l.startswith("#") & (F.instr(l, ":") > 0))
    pairs = F.transform(lines, lambda l: F.struct(
        F.trim(F.substring_index(l, ":", 1)).alias("key"),
        F.trim(F.substring(l, F.instr(l, ":") + 1, F.length(l))).alias("value")))
    d = df.withColumn("_kv", F.filter(pairs, lambda p: p["key"] != "")).withColumn("body", body) \
        .withColumn("has_frontmatter", has)
    # later lines override earlier ones, as object assignment does
    d = d.withColumn("_m", F.map_from_entries(F.transform(
        F.array_distinct(F.transform("_kv", lambda p: p["key"])),
        lambda k: F.struct(k.alias("key"), F.element_at(F.filter("_kv", lambda p: p["key"] == k), -1)["value"].alias("value")))))
    name = F.trim(F.coalesce(F.try_element_at("_m", F.lit("name")), F.lit("")))
    desc = F.trim(F.coalesce(F.try_element_at("_m", F.lit("description")), F.lit("")))
    lists = {k: F.filter(F.split(F.try_element_at("_m", F.lit(k)), r"\s+"), lambda x: x != "") for k in LIST_KEYS}
    d = d.withColumn("name", name).withColumn("description", desc)
    for k, v in lists.items():
        d = d.withColumn(k.replace("-", "_"), v)
    errs = F.array_compact(F.array(
        F.when(~F.col("has_frontmatter"), F.lit("no frontmatter block")),
        F.when((F.char_length("name") < 1) | (F.char_length("name") > 64), F.lit("invalid name")),
        F.when(~F.regexp_like(F.col("name"), F.lit(NAME_PATTERN)), F.lit("name not kebab-case")),
        F.when((F.char_length("description") < 1) | (F.char_length("description") > 1024), F.lit("invalid description"))))
    d = d.withColumn("errors", errs).drop("_kv", "_m")
    # copies per name: a grouped count (partial aggregate) joined back
    copies = d.groupBy("name").agg(F.count(F.lit(1)).alias("_copies"))
    return d.join(copies, "name", "left").withColumn(
        "duplicate_name", (F.col("_copies") > 1) & (F.col("name") != "")).drop("_copies")


# --------------------------------------------------------------- S15 export


#: between the answers of a markdown export: a line with a form feed
PAGE_BREAK = "\n\f\n"


def _escaped(c: Column, *marks: tuple[str, str]) -> Column:
    """The marks as backslash and letter, backslashes doubled."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for mark, letter in marks:
        c = F.replace(c, F.lit(mark), F.lit(f"\\{letter}"))
    return c


def _plain(c: Column, *marks: tuple[str, str]) -> Column:
    def part(x: Column) -> Column:
        for mark, letter in marks:
            x = F.replace(x, F.lit(f"\\{letter}"), F.lit(mark))
        return x
    return F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\")


_LINE_MARKS, _PAGE_MARKS = (("\n", "n"), ("\r", "r")), (("\f", "f"),)


def export_answers(df: DataFrame, path: str, fmt: str = "json", text_col: str = "answer",
                   mode: str = "overwrite", id_col: str | None = None) -> None:
    """Write answers: ``json`` lines and ``parquet`` with all columns; ``text``,
    an answer a line, line breaks as ``\\n``; ``markdown``, a heading with the
    value of ``id_col`` over each answer, page breaks between them.
    ``read_answers`` reads them back as they were; null answers are empty there."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if fmt == "text":
        df.select(_escaped(body, *_LINE_MARKS)).write.mode(mode).text(path)
    elif fmt == "markdown":
        if id_col is None:
            raise ValueError("markdown needs an id column")
        head = _escaped(F.coalesce(F.col(id_col).cast("string"), F.lit("")), *_LINE_MARKS)
        df.select(F.concat(F.lit("# "), head, F.lit("\n\n"), _escaped(body, *_PAGE_MARKS))).write.mode(mode).option("lineSep", PAGE_BREAK).text(path)
    elif fmt == "json":
        df.write.mode(mode).json(path)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(fmt)


def read_answers(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """An export of ``export_answers``: ``answer``, with ``id`` for markdown, all columns for json and parquet."""
    if fmt == "text":
        return spark.read.text(path).select(_plain(F.col("value"), *_LINE_MARKS).alias("answer"))
    if fmt == "markdown":
        page = spark.read.option("lineSep", PAGE_BREAK).text(path)
        at = F.instr("value", "\n\n")
        return page.select(_plain(F.substring("value", F.lit(3), at - 3), *_LINE_MARKS).alias("id"),
                           _plain(F.substring(F.col("value"), at + 2, F.length("value")), *_PAGE_MARKS).alias("answer"))
    if fmt not in ("json", "parquet"):
        raise ValueError(fmt)
    return spark.read.format(fmt).load(path)
