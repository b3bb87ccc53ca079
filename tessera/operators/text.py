"""Text and document jobs: chunking, HTML and markdown parsing, regex field
extraction, structured replies, verbatim citation checks.

Fixed and token windows, markdown sections, extraction and the citation
check are column expressions. Recursive chunking and HTML parsing need real
per-document code: they run in ``mapInPandas`` over Arrow batches, one
document at a time inside the task (whole texts, no prefixes).
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.operators.filters import js_regex, regex_groups, valid_regex
from tessera.session import arrow_slices, cut_lineage, ensure_parallel

# --------------------------------------------------------------------------
# chunking
# --------------------------------------------------------------------------


def chunk_fixed(df: DataFrame, text: str = "text", size: int = 512, overlap: int = 50,
                id_col: str = "doc_id") -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after
    the previous; the last start is before ``len - overlap`` so that no chunk
    is pure overlap. Output ``(id, chunk_no, start, chunk)``."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    from tessera.session import ensure_parallel

    step = size - overlap
    n = F.char_length(F.col(text))
    starts = F.sequence(F.lit(0), F.greatest(n - F.lit(overlap) - 1, F.lit(0)), F.lit(step))
    src = ensure_parallel(df.select(id_col, text))
    return src.select(id_col, F.posexplode(starts).alias("chunk_no", "start"), F.col(text).alias("_t")) \
        .select(id_col, "chunk_no", "start", F.substring(F.col("_t"), F.col("start") + 1, F.lit(size)).alias("chunk"))


def chunk_token(df: DataFrame, text: str = "text", size: int = 200, overlap: int = 20,
                id_col: str = "doc_id") -> DataFrame:
    """Windows of ``size`` words (split on whitespace), overlap in words."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    from tessera.session import ensure_parallel

    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    d = ensure_parallel(df.select(id_col, text)).select(id_col, words.alias("_w"))
    n = F.size("_w")
    starts = F.sequence(F.lit(0), F.greatest(n - F.lit(overlap) - 1, F.lit(0)), F.lit(step))
    return d.select(id_col, F.posexplode(starts).alias("chunk_no", "start"), "_w").select(
        id_col, "chunk_no", "start", F.array_join(F.slice("_w", F.col("start") + 1, F.lit(size)), " ").alias("chunk"))


SEPARATORS = ("\n\n", "\n", ". ", " ")


def _split_recursive(text: str, size: int, seps: Sequence[str] = SEPARATORS) -> list[str]:
    """Pieces no longer than ``size``: split on the first separator that
    occurs, recurse into pieces that are still too long, hard-cut at the end."""
    if len(text) <= size:
        return [text] if text else []
    for i, sep in enumerate(seps):
        if sep in text:
            parts = text.split(sep)
            out: list[str] = []
            for j, p in enumerate(parts):
                piece = p + (sep if j < len(parts) - 1 else "")
                if len(piece) <= size:
                    if piece:
                        out.append(piece)
                else:
                    out.extend(_split_recursive(piece, size, seps[i + 1:]))
            return out
    return [text[k:k + size] for k in range(0, len(text), size)]


def recursive_chunks(text: str, size: int, overlap: int) -> list[str]:
    """Join the pieces back up to ``size`` chars; each chunk repeats the last
    ``overlap`` characters of the previous one."""
    pieces = _split_recursive(text or "", max(size - overlap, 1))
    chunks: list[str] = []
    cur = ""
    for p in pieces:
        if cur and len(cur) + len(p) > size - overlap:
            chunks.append(cur)
            cur = ""
        cur += p
    if cur:
        chunks.append(cur)
    if overlap <= 0:
        return chunks
    out = []
    for i, c in enumerate(chunks):
        prev_tail = chunks[i - 1][-overlap:] if i > 0 else ""
        out.append(prev_tail + c)
    return out


def chunk_recursive(df: DataFrame, text: str = "text", size: int = 512, overlap: int = 50,
                    id_col: str = "doc_id") -> DataFrame:
    """Split on paragraph, line, sentence, word until pieces fit; join up
    with overlap. Runs per document in ``mapInArrow``, a slice of a batch at a time."""
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("chunk_no", T.IntegerType()),
                           T.StructField("chunk", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for b in arrow_slices(batches):
            ids, nos, chunks = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for k, c in enumerate(recursive_chunks(t or "", size, overlap)):
                    ids.append(i)
                    nos.append(k)
                    chunks.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, nos, chunks), target)], schema=target)

    return ensure_parallel(df.select(id_col, text)).mapInArrow(run, schema)


def sentences(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Sentences (split after ``.``, ``!``, ``?`` or a line break), numbered."""
    parts = F.filter(F.transform(F.split(F.col(text), r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s)), lambda s: s != "")
    return df.select(id_col, F.posexplode(parts).alias("sent_no", "sentence"))


def chunk_semantic(df: DataFrame, text: str = "text", threshold: float = 0.2, dims: int = 256,
                   id_col: str = "doc_id") -> DataFrame:
    """Cut where neighbouring sentences differ: a sentence starts a new chunk
    when its cosine to the previous one is below ``threshold``. Vectors are
    the hashed-word embedding of :func:`tessera.operators.vectors.embed`."""
    from tessera.operators.vectors import signed_buckets, unit_rows

    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("chunk_no", T.LongType()),
                           T.StructField("chunk", T.StringType()), T.StructField("n_sentences", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        done: list[tuple] = []
        key, no, held, prev = None, -1, [], None  # the open chunk, and the vector of its last sentence
        for b in arrow_slices(batches):
            words = b.column(2)
            n = np.asarray(pa.compute.list_value_length(words))
            signed = np.asarray(words.flatten(), dtype=np.int64)
            cell = np.repeat(np.arange(b.num_rows), n) * dims + np.abs(signed) - 1
            v = np.bincount(cell, np.sign(signed), b.num_rows * dims).reshape(b.num_rows, dims)
            v = unit_rows(v).astype(np.float32).astype(np.float64)
            # sums run from the first dimension to the last, as in the column functions
            before = np.vstack([np.zeros((1, dims)) if prev is None else prev, v])
            size = np.sqrt(np.cumsum(before * before, axis=1)[:, -1])
            dot, d = np.cumsum(v * before[:-1], axis=1)[:, -1], size[1:] * size[:-1]
            far = np.divide(dot, d, out=np.zeros_like(dot), where=d > 0) < threshold
            for i, sentence, cut in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), far.tolist()):
                if held and (cut or i != key):
                    done.append((key, no, " ".join(held), len(held)))
                    held = []
                if no < 0 or i != key:
                    key, no = i, 0
                elif cut:
                    no += 1
                held.append(sentence)
            prev = v[-1:]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), target)], schema=target)
                done = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((key, no, " ".join(held), len(held)), target)], schema=target)

    # a document's sentences follow each other in one task; no vector leaves it
    s = sentences(df.select(id_col, text).repartition(id_col), text, id_col).sortWithinPartitions(id_col, "sent_no", "sentence")
    return s.select(id_col, "sentence", signed_buckets(F.col("sentence"), dims)).mapInArrow(run, schema)


# --------------------------------------------------------------------------
# HTML and markdown
# --------------------------------------------------------------------------

# fixed values: elements whose content is not page text
SKIP_TAGS = ("script", "style", "nav", "noscript", "template", "head")
BLOCK_TAGS = ("p", "div", "article", "section", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6",
              "br", "tr", "table", "header", "footer", "main", "blockquote", "pre")


#: elements without content, and those that may stand in a head
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
HEAD_TAGS = ("title", "base", "link", "meta", "script", "style", "noscript", "template")
#: elements that the page's own text starts with: an open nav ends before them
CONTENT_TAGS = ("body", "main", "article")


class _TextParser(HTMLParser):
    """Text outside of the skipped elements, by a stack of open elements.

    An end tag closes all elements opened inside its own; without an open one
    it is ignored. A head ends at the first thing that cannot stand in it, a
    nav at the page's own content; a skipped element that is still open at the
    end of the page was never closed, and its text is taken back.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title: list[str] = []
        self.parts: list[str] = []
        self.open: list[tuple[str, int]] = []  # element, length of ``parts`` where it began

    def _close(self, at: int) -> None:
        """Ends the elements from place ``at`` of the stack on; skipped ones lose their text."""
        for tag, start in self.open[at:]:
            if tag in SKIP_TAGS:
                del self.parts[start:]
                break
        del self.open[at:]

    def _end(self, *tags: str) -> bool:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in tags:
                self._close(at)
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS and tag not in ("head", "html"):
            self._end("head")
        if tag in CONTENT_TAGS:
            self._end("nav")
        if tag in BLOCK_TAGS:
            self.parts.append("\n")
        if tag not in VOID_TAGS:
            self.open.append((tag, len(self.parts)))

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self._end(tag)
        if tag in BLOCK_TAGS:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "title":
            self.title.append(data)
            return
        if data.strip() and self.open and self.open[-1][0] == "head":
            self._end("head")
        if not (self.open and self.open[-1][0] in ("script", "style")):
            self.parts.append(data)


def html_to_text(doc: str) -> tuple[str, str]:
    p = _TextParser()
    try:
        p.feed(doc or "")
        p.close()
    except Exception:  # noqa: BLE001 - malformed markup keeps what was read
        pass
    title = " ".join("".join(p.title).split())
    lines = [" ".join(line.split()) for line in "".join(p.parts).split("\n")]
    return title, "\n".join(line for line in lines if line)


def parse_html(df: DataFrame, col: str = "html", id_col: str = "page_id") -> DataFrame:
    """Pages to ``title`` and clean ``text`` (scripts, styles, navigation and
    comments dropped; blocks become lines). Per page in ``mapInPandas``."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType),
                           T.StructField("title", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            res = [html_to_text(h) for h in b[col]]
            yield pd.DataFrame({id_col: b[id_col], "title": [r[0] for r in res], "text": [r[1] for r in res]})

    from tessera.session import ensure_parallel

    return ensure_parallel(df.select(id_col, col)).mapInPandas(run, schema)


def parse_markdown(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Headings and sections: each line is numbered, ``#``-lines are headings,
    every other line belongs to the nearest heading above it (carried
    forward with ``last(..., ignorenulls)`` within the document)."""
    from tessera.operators.ordering import carry_forward

    lines = df.select(id_col, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("line_no", "line"))
    h = lines.withColumn("_m", F.regexp_extract("line", r"^(#{1,6})\s+(.*)$", 1)) \
        .withColumn("level", F.when(F.col("_m") != "", F.length("_m")))\
        .withColumn("_head", F.when(F.col("_m") != "", F.struct(
            F.col("line_no").alias("at"), F.regexp_extract("line", r"^(#{1,6})\s+(.*)$", 2).alias("heading"),
            F.col("level").alias("level"))))
    c = carry_forward(h, [id_col], ["line_no"], "_head", "_sec", include_current=True)
    body = c.filter(F.col("_m") == "")
    g = body.groupBy(id_col, F.coalesce(F.col("_sec.at"), F.lit(-1)).alias("section_line")).agg(
        F.first("_sec.heading", ignorenulls=True).alias("heading"),
        F.first("_sec.level", ignorenulls=True).alias("level"),
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_l"))
    return g.select(id_col, "section_line", "heading", "level",
                    F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("body"))


# --------------------------------------------------------------------------
# extraction
# --------------------------------------------------------------------------


#: a group that may be left out: an alternative, or a quantifier that allows none
_FREE_GROUP = re.compile(r"\||\)(\?|\*|\{0)")


def _first_group(pattern: str) -> Callable[[Column], Column]:
    """Group 1 of the first match, or the whole match where the group took no part."""
    source = re.sub(r"\\k<(\w+)>", r"(?P=\1)", js_regex(pattern).replace("\\z", "\\Z"))

    @F.pandas_udf(T.StringType())
    def first(texts: pd.Series) -> pd.Series:
        import regex

        p = regex.compile(source, regex.ASCII)
        found = [p.search(t) if isinstance(t, str) else None for t in texts]
        return pd.Series([None if m is None else m[0] if m[1] is None else m[1] for m in found], dtype=object)

    return first


def extract_fields(df: DataFrame, text: str, fields: Sequence[dict]) -> DataFrame:
    """Per field ``{name, pattern, type}``: first match, group 1 (by number or
    name) if the pattern has one that takes part, else the whole match, cast to
    int / float / bool / str; null when nothing matches. An invalid pattern
    raises. A column expression, but for patterns whose first group need not
    take part in a match: only there an Arrow UDF can tell an empty group from
    none."""
    cols = {}
    t = F.col(text)
    for f in fields:
        pat = f["pattern"]
        if not valid_regex(pat):
            raise ValueError(f"invalid pattern {pat!r}")
        jp = js_regex(pat)
        group = min(1, regex_groups(pat))
        if group and _FREE_GROUP.search(pat):
            raw = _first_group(pat)(t)
        else:
            raw = F.when(F.regexp_like(t, F.lit(jp)), F.regexp_extract(t, jp, group))
        typ = f.get("type", "str")
        if typ == "int":
            v = F.regexp_substr(raw, F.lit(r"^\s*[+-]?\d+")).try_cast("long")
        elif typ == "float":
            v = F.regexp_substr(raw, F.lit(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")).try_cast("double")
        elif typ == "bool":
            v = F.when(raw.isNotNull(), F.lower(F.trim(raw)).isin("true", "1", "yes"))
        else:
            v = raw
        cols[f["name"]] = v
    return df.withColumns(cols)


def extract_table(df: DataFrame, col: str, schema: dict, path: str = "line_items",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Structured JSON replies to one row per element of ``path``."""
    from tessera.operators.shaping import apply_json_schema

    p = apply_json_schema(df, col, schema, out="_v")
    return p.select(*keep, F.inline_outer(F.col(f"_v.{path}")))


# --------------------------------------------------------------------------
# verbatim citations
# --------------------------------------------------------------------------

SHINGLE = 5
#: quotes, and bytes of them, of one automaton (about 100 bytes a character in a task)
AUTOMATON_QUOTES, AUTOMATON_BYTES = 50_000, 1 << 20


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def _shingles(tokens: Column, k: int) -> Column:
    n = F.size(tokens)
    starts = F.when(n >= k, F.sequence(F.lit(0), n - F.lit(k))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i + 1, k), " "))


def citation_matches(cites: DataFrame, corpus: DataFrame, cite_id: str = "cite_id", text: str = "text",
                     doc_id: str = "doc_id") -> DataFrame:
    """Every (cite_id, doc_id) where the quoted text occurs verbatim in the document.

    Candidate pairs come from an equi join on one word shingle of the quote:
    the shingle is made of *inner* words (the first and last words of a
    quote may be partial words in the document), of length ``min(5, inner
    words)``. Among the quote's shingles the rarest in the corpus is used, so
    hot boilerplate shingles do not fan out. Every candidate is confirmed
    with ``contains``. Quotes with no inner word (1-2 words) go into an
    automaton that finds all of them in one pass over a text; blocks of bounded
    size, a scan of the corpus for each. An empty quote is in every text.
    """
    q = cites.select(F.col(cite_id).alias("cite_id"), F.col(text).alias("quote")) \
        .withColumn("_tok", _tokens(F.col("quote")))
    q = q.withColumn("_inner", F.slice("_tok", 2, F.greatest(F.size("_tok") - 2, F.lit(0))))
    q = q.withColumn("_k", F.least(F.lit(SHINGLE), F.size("_inner")))
    long_q = q.filter(F.col("_k") >= 1)
    ks = [r[0] for r in long_q.select("_k").distinct().collect()]  # at most 5 values
    docs = corpus.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("doc"))
    parts = []
    if ks:
        qsh = long_q.select("cite_id", "_k", F.explode(F.transform(
            F.sequence(F.lit(0), F.size("_inner") - F.col("_k")),
            lambda i: F.array_join(F.slice("_inner", i + 1, F.col("_k")), " "))).alias("sh")).distinct()
        dtok = docs.select("doc_id", _tokens(F.col("doc")).alias("_dt"))
        dsh = None
        for k in sorted(ks):
            part = dtok.select("doc_id", F.lit(k).alias("_k"), F.explode(_shingles(F.col("_dt"), k)).alias("sh"))
            dsh = part if dsh is None else dsh.unionByName(part)
        # stored: the shingles of the corpus are made once, for the frequencies and the candidates
        dsh = cut_lineage(dsh.join(qsh.select("_k", "sh").distinct(), on=["_k", "sh"], how="left_semi").distinct())
        freq = dsh.groupBy("_k", "sh").agg(F.count(F.lit(1)).alias("_df"))
        rare = qsh.join(freq, on=["_k", "sh"], how="left").fillna({"_df": 0}).groupBy("cite_id").agg(
            F.min_by(F.struct("_k", "sh"), F.struct("_df", "sh")).alias("_r")).select("cite_id", "_r._k", "_r.sh")
        cand = rare.join(dsh, on=["_k", "sh"], how="inner").select("cite_id", "doc_id")
        ok = cand.join(long_q.select("cite_id", "quote"), "cite_id").join(docs, "doc_id") \
            .filter(F.col("doc").contains(F.col("quote")))
        parts.append(ok.select("cite_id", "doc_id"))
    parts += _short_quote_matches(q.filter(F.col("_k") < 1).select("cite_id", "quote"), docs)
    if not parts:
        return cites.sparkSession.createDataFrame([], T.StructType([
            T.StructField("cite_id", cites.schema[cite_id].dataType),
            T.StructField("doc_id", corpus.schema[doc_id].dataType)]))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res.distinct()


def _short_quote_matches(quotes: DataFrame, docs: DataFrame) -> list[DataFrame]:
    """(cite_id, doc_id) of every quote in every text that holds it, a scan for each block of quotes."""
    quotes = cut_lineage(quotes.where("quote IS NOT NULL").distinct())
    size = quotes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("quote")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-size["n"] // AUTOMATON_QUOTES), -(-size["bytes"] // AUTOMATON_BYTES))
    schema = T.StructType([T.StructField("cite_id", quotes.schema["cite_id"].dataType), T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    docs = ensure_parallel(docs.where("doc IS NOT NULL"))
    parts = []
    for i in range(blocks):
        rows = quotes.where(F.pmod(F.xxhash64("cite_id", "quote"), F.lit(blocks)) == i).collect()  # about AUTOMATON_QUOTES
        asked: dict[str, list] = {}
        for r in rows:
            asked.setdefault(r["quote"], []).append(r["cite_id"])
        if asked:
            parts.append(docs.select("doc_id", "doc").mapInPandas(_automaton_pass(docs.sparkSession.sparkContext.broadcast(asked)), schema))
    return parts


def _automaton_pass(sent) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        asked = sent.value
        automaton = ahocorasick.Automaton()
        for quote in asked:
            if quote:
                automaton.add_word(quote, quote)
        automaton.make_automaton()
        for pdf in batches:
            cite, doc = [], []
            for key, text in zip(pdf["doc_id"].astype(object), pdf["doc"]):
                found = {quote for _, quote in automaton.iter(text)} if len(automaton) else set()
                for quote in found | ({""} & asked.keys()):
                    cite += asked[quote]
                    doc += [key] * len(asked[quote])
            yield pd.DataFrame({"cite_id": pd.Series(cite, dtype=object), "doc_id": pd.Series(doc, dtype=object)})

    return run


def verify_citations(cites: DataFrame, corpus: DataFrame, cite_id: str = "cite_id", text: str = "text",
                     doc_id: str = "doc_id") -> DataFrame:
    """Is each quote verbatim in the corpus? ``cite_id, found, n_docs``
    (failures are the rows with ``found = false``)."""
    m = citation_matches(cites, corpus, cite_id, text, doc_id)
    n = m.groupBy("cite_id").agg(F.count(F.lit(1)).alias("n_docs"))
    res = cites.select(F.col(cite_id).alias("cite_id")).distinct()
    return res.join(n, "cite_id", "left").select(
        "cite_id", F.col("n_docs").isNotNull().alias("found"), F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"))
