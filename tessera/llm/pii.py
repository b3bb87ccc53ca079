"""Personal data: fixed patterns, and an information-theoretic sanitiser.

Protected entities are the matches of the fixed patterns. How much a term
reveals of a kind of entity is estimated from the whole corpus: the pointwise
mutual information of "the term stands in a document with such an entity"
against the information content of the entity kind. Every word outside the
entities is a term. One whose share of that information is ``GENERALISE`` or
more is generalised wherever it stands in a document that holds the kind, from
``REMOVE`` on it is removed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import chunks, map_texts, word_hashes_of
from tessera.session import cut_lineage

# fixed values: kinds and base patterns of the contract. The look-behind and the
# possessive runs only keep long runs of digits linear: a match never starts inside a run
KINDS = ("email", "ip", "card", "phone")
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: documents' weight of a kind's base rate in the estimate of how often a term's documents hold it
PRIOR_DOCS = 3
GENERALISE, REMOVE = 0.75, 0.9
#: terms that one pass over the corpus counts or finds
TERMS_PER_PASS = 1_000_000
TERMS = "array<struct<start:long,end:long,remove:boolean>>"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses: each @ with the name
    characters before it, back to the last match at most."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_NAME:
            start -= 1
        host = EMAIL_HOST.match(text, at) if start < at else None
        done = host.end() if host else at
        if host:
            out.append((start, done))
        at = text.find("@", max(done, at + 1))
    return out


def luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(double[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with blanks for every word that lies in an entity, wholly or in
    part, and for the entities; all other characters keep their places."""
    out, done = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if b <= done:
            continue
        a = max(a, done)
        if WORD.match(text[a]):
            while a > done and WORD.match(text[a - 1]):
                a -= 1
        if WORD.match(text[b - 1]) and (rest := WORD.match(text, b)):
            b = rest.end()
        out += [text[done:a], " " * (b - a)]
        done = b
    return "".join(out) + text[done:]


def _find(texts: list[str]) -> dict[str, list]:
    spans = [base_spans(t) for t in texts]
    count = lambda kind: [sum(x[0] == kind for x in s) for s in spans]
    listed = [",".join(f"{k}:{a}:{b}" for k, a, b in s) for s in spans]
    return {**{f"n_{k}": count(k) for k in KINDS}, "base_spans": listed,
            "base_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in listed]}


def _with_kinds(texts: list[str]) -> tuple[list[int], list[str], np.ndarray]:
    """Places of the texts that hold an entity, those texts masked, and for
    each which of the kinds it holds."""
    found = [(i, t, s) for i, t in enumerate(texts) if (s := base_spans(t))]
    held = np.array([[any(x[0] == k for x in s) for k in KINDS] for _, _, s in found], dtype=bool).reshape(-1, len(KINDS))
    return [i for i, _, _ in found], [masked(t, s) for _, t, s in found], held


def count_beside(docs: DataFrame) -> DataFrame:
    """``kind, term, n_both``: in how many documents with such an entity each
    term stands, counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for a, b in chunks(texts):
                _, plain, held = _with_kinds([t or "" for t in texts.slice(a, b - a).to_pylist()])
                if not plain:
                    continue
                words, at = word_hashes_of(plain)
                terms, place = np.unique(words, return_inverse=True)
                pairs = np.unique(np.repeat(np.arange(len(plain)), np.diff(at)) * (len(terms) + 1) + place)
                doc, term = pairs // (len(terms) + 1), pairs % (len(terms) + 1)
                n = [np.bincount(term[held[doc, k]], minlength=len(terms)) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), *map(pa.array, n)], ["term", *KINDS])

    some = docs.select("text").mapInArrow(count, "term long, " + ", ".join(f"{k} long" for k in KINDS))
    some = some.groupBy("term").agg(*[F.sum(k).alias(k) for k in KINDS])
    return some.select("term", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n_both")) for k in KINDS])).alias("x")).select(
        "x.kind", "term", "x.n_both").where("n_both > 0")


def count_documents(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``term, n_term``: in how many documents each of the given terms (sorted
    hashes) stands, counted per batch before the shuffle."""
    wanted = np.sort(terms.view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in chunks(texts):
                words, at = word_hashes_of([t or "" for t in texts.slice(a, b - a).to_pylist()])
                place = np.minimum(np.searchsorted(wanted, words), len(wanted) - 1)
                hit = np.flatnonzero(wanted[place] == words)
                doc = np.searchsorted(at, hit, side="right")
                pairs = np.unique(doc * len(wanted) + place[hit])
                total += np.bincount(pairs % len(wanted), minlength=len(wanted))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(total[some])], ["term", "n"])

    return docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def blocks_of(terms: DataFrame, n: int) -> Iterator[DataFrame]:
    """``terms``, of which there are ``n``, in parts of about TERMS_PER_PASS; all rows of a term in one."""
    passes = max(1, -(-n // TERMS_PER_PASS))
    for i in range(passes):
        yield terms.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == i)


def disclosing_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``kind, term, share`` of the terms that reveal ``GENERALISE`` or more of
    a kind of entity.

    With N documents, ``n_kind`` of them with the kind, ``n_term`` with the term
    and ``n_both`` with the term and such an entity, the kind is expected in a
    document with the term at the rate ``(n_both + PRIOR_DOCS * n_kind / N) /
    (n_term + PRIOR_DOCS)``, so that a rare term has to show more than its one
    document. The term's information is log2 of that rate over n_kind / N, and
    the kind's is log2(N / n_kind). A kind that every document holds has no
    information, and no term reveals it.
    """
    kinds = found.agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col(f"n_{k}") > 0).cast("long")).alias(k) for k in KINDS]).first()
    rates = {k: kinds[k] / kinds["n"] for k in KINDS if kinds["n"] and 0 < kinds[k] < kinds["n"]}
    none = docs.sparkSession.createDataFrame([], "kind string, term long, share double")
    if not rates:
        return none
    rate = F.element_at(F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(v))]), F.col("kind"))
    share = lambda n: F.lit(1.0) + F.log2((F.col("n_both") + PRIOR_DOCS * rate) / (n + PRIOR_DOCS)) / -F.log2(rate)
    # n_both is the least that n_term can be: what falls short with it falls short with any
    both = count_beside(docs).where(F.col("kind").isin(*rates)).where(share(F.col("n_both")) >= GENERALISE)
    both = cut_lineage(both)
    terms = both.select("term").distinct()
    counts = None
    for part in blocks_of(terms, terms.count()):  # a block of terms of bounded size against all documents
        block = part.toPandas()["term"].to_numpy(np.int64)
        if len(block):
            c = count_documents(docs, block)
            counts = c if counts is None else counts.union(c)
    if counts is None:
        return none
    judged = both.join(counts, "term").withColumn("share", share(F.col("n_term")))
    return judged.where(F.col("share") >= GENERALISE).select("kind", "term", "share")


def term_spans(docs: DataFrame, block: np.ndarray, shares: np.ndarray) -> DataFrame:
    """``doc_id, th, terms``: every occurrence of the given terms (sorted
    hashes) in documents that hold a kind they reveal; ``shares`` has a row for
    each term and a column for each kind, 0 where the term reveals little."""

    def find(texts: list[str]) -> dict[str, list]:
        out: list[list] = [[] for _ in texts]
        where, plain, held = _with_kinds(texts)
        words, at = word_hashes_of(plain) if plain else (np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64))
        place = np.minimum(np.searchsorted(block, words), len(block) - 1)
        hit = np.flatnonzero(block[place] == words)
        doc = np.searchsorted(at, hit, side="right") - 1
        share = (shares[place[hit]] * held[doc]).max(axis=1, initial=0.0)
        for d in np.unique(doc[share > 0]):
            mine = (doc == d) & (share > 0)
            spans = [m.span() for m in WORD.finditer(plain[d])]
            out[where[d]] = [{"start": spans[i][0], "end": spans[i][1], "remove": bool(x >= REMOVE)}
                             for i, x in zip((hit[mine] - at[d]).tolist(), share[mine])]
        return {"terms": out}

    return map_texts(docs, find, ["doc_id", "th"], "text", f"terms {TERMS}").where(F.size("terms") > 0)


def every_term_span(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """:func:`term_spans` of all ``terms``, one row for a document, by start."""
    terms = cut_lineage(terms)
    out = None
    for part in blocks_of(terms, terms.count()):  # a block of terms of bounded size against all documents
        rows = part.toPandas()
        if not len(rows):
            continue
        block, place = np.unique(rows["term"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        shares = np.zeros((len(block), len(KINDS)))
        shares[place, [KINDS.index(k) for k in rows["kind"]]] = rows["share"]
        # repeated rows have the same spans
        some = term_spans(docs, block, shares).groupBy("doc_id", "th").agg(F.first("terms").alias("terms"))
        out = some if out is None else out.union(some)
    if out is None:
        return docs.sparkSession.createDataFrame([], docs.select("doc_id", "th").schema).select("*", F.array().cast(TERMS).alias("terms"))
    return out.groupBy("doc_id", "th").agg(F.array_sort(F.flatten(F.collect_list("terms"))).alias("terms"))  # those of one document


def scan_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, th, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans,
    terms`` (``terms``: start, end and whether to remove it).

    Reads ``doc_id, text``; other columns are ignored. Null texts count as
    empty; offsets are code points, ends exclusive. ``spans`` lists the base
    spans and then ``term:start:end`` of every occurrence of a term that
    discloses a kind of entity that the document holds, by start. Repeated rows give repeated results; an empty table gives
    no rows.
    """
    src = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    found = cut_lineage(map_texts(src, _find, ["doc_id", "th"], "text",
                                  "n_email long, n_ip long, n_card long, n_phone long, base_spans string, base_sha256 string"))
    per_doc = every_term_span(src, disclosing_terms(found, src)).withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    full = found.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    full = full.withColumn("terms", F.coalesce("terms", F.array().cast(TERMS)))
    said = F.transform("terms", lambda t: F.concat(F.lit("term:"), t["start"].cast("string"), F.lit(":"), t["end"].cast("string")))
    every = F.array_join(F.concat(F.when(F.col("base_spans") == "", F.array().cast("array<string>")).otherwise(F.array("base_spans")), said), ",")
    return full.select("doc_id", "th", "n_email", "n_ip", "n_card", "n_phone", F.size("terms").cast("long").alias("n_term"),
                       "base_sha256", every.alias("spans"), "terms")


def sanitise_text(text: str | None, spans: str, terms: list) -> str | None:
    """Text with entities generalised to ``[kind]``, disclosing terms to
    ``[term]``, and removed terms left out; overlapping spans by the first."""
    if text is None:
        return None
    parts = [x.split(":") for x in spans.split(",") if x]
    marks = {(int(t["start"]), int(t["end"])): "" for t in terms if t["remove"]}
    out, done = [], 0
    for a, b, kind in sorted((int(a), int(b), k) for k, a, b in parts):
        if a >= done:
            out += [text[done:a], marks.get((a, b), f"[{kind}]") if kind == "term" else f"[{kind}]"]
            done = b
    return "".join(out) + text[done:]


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every text sanitised; other columns pass through."""
    import pandas as pd

    found = scan_personal_data(docs).select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "spans", "terms").dropDuplicates(["id", "hash"])
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    both = rows.join(found, F.col("own").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash")), "left")
    clean = F.pandas_udf(lambda t, s, x: pd.Series([sanitise_text(*r) for r in zip(t, s, x)], dtype=object), "string")
    text = clean("row.text", F.coalesce("spans", F.lit("")), "terms")
    return both.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
