"""Word rules and batch helpers shared by the training-data operators.

Two word rules appear in the contracts:

* *plain words*: runs of characters other than space and ``\\t \\n \\v \\f \\r``;
* *folded words*: after lower-casing ``A-Z``, runs of ASCII letters, digits
  and any character beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLAIN_SPACE = r"[\x20\x09-\x0D]+"
FOLDED_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: texts of about so many bytes are handled at once inside a task
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _words(text: Column, gap: str) -> Column:
    return F.array_remove(F.split(text, gap), "")


def plain_words(text: Column) -> Column:
    """Array of plain words; null and blank texts have none."""
    return _words(F.coalesce(text, F.lit("")), PLAIN_SPACE)


def plain_word_count(text: Column) -> Column:
    """Number of plain words; null and blank texts have none."""
    return F.size(plain_words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else (``lower`` does so where all is ASCII); null is empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(
        F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def folded_words(text: Column) -> Column:
    """Array of folded words; null and blank texts have none."""
    return _words(lower_ascii(text), FOLDED_GAP)


#: rows of a few fixed-width columns that may be broadcast, about 64 MB
SMALL_ROWS = 1_000_000


def small(rows: DataFrame) -> DataFrame:
    """``rows`` (stored, and of a few fixed-width columns) marked for broadcast
    if they are counted to be SMALL_ROWS at most; more are joined by shuffle."""
    return F.broadcast(rows) if rows.count() <= SMALL_ROWS else rows


# --- Arrow batches -----------------------------------------------------------

def map_texts(df: DataFrame, fn: Callable[[list[str]], dict[str, list]], keys: list[str], text: str, schema: str) -> DataFrame:
    """Apply ``fn`` to slices of the text column; the key columns pass through.

    ``fn`` gets a list of texts (null: empty) of about ``CHUNK_BYTES`` together
    and returns the further columns of ``schema``, one value for each text.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string

    extra: StructType = _parse_datatype_string(schema)
    src = df.select(*[F.col(k) for k in keys], F.col(text).alias("__text__"))
    fields = [src.schema[k] for k in keys] + list(extra)
    names = [f.name for f in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in chunks(texts):
                out = fn([t or "" for t in texts.slice(a, b - a).to_pylist()])
                cols = [batch.column(i).slice(a, b - a).cast(types[i]) for i in range(len(keys))]
                cols += [pa.array(out[n], types[len(keys) + i]) for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return src.mapInArrow(run, StructType(fields))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Slices [a, b) of about CHUNK_BYTES each; one text at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if i > a and total + n > CHUNK_BYTES:
            yield a, i
            a, total = i, 0
        total += int(n)
    if a < len(sizes):
        yield a, len(sizes)


# --- hashed folded words (numpy) --------------------------------------------

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BASE = U(0x9E3779B97F4A7C15 | 1)
_SEG = 1 << 20
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (multiply and xor-shift rounds)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        inverse = U(pow(int(_BASE), -1, 1 << 64))
        for k, base in (("p", _BASE), ("i", inverse)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POW[k] = np.multiply.accumulate(steps)
    return _POW["p"], _POW["i"]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the folded words of a UTF-8 text, in order.

    Long texts are cut between words, so that memory beyond the result stays
    at a few times ``_SEG`` bytes; only a single longer word needs more.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    parts, at = [], 0
    while at < len(raw):
        end = min(at + _SEG, len(raw))
        while end < len(raw):  # back to a gap, or on to the next one
            gaps = np.flatnonzero(~_IS_WORD[_LOWER[raw[at:end]]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + _SEG, len(raw))
        parts.append(_segment_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _segment_hashes(raw: np.ndarray) -> np.ndarray:
    low = _LOWER[raw]
    inside = np.concatenate(([False], _IS_WORD[low], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    p, inv = _powers(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((low.astype(np.uint64) + U(1)) * p[: len(raw)])))
    return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def word_hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts, and the offsets of each text (n + 1)."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    if sum(map(len, data)) <= 2 * CHUNK_BYTES:
        joined = np.frombuffer(b"\n".join(data), dtype=np.uint8)
        low = _LOWER[joined]
        inside = np.concatenate(([False], _IS_WORD[low], [False]))
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        bounds = np.concatenate(([0], np.cumsum([len(d) + 1 for d in data])))
        return _segment_hashes(joined), np.searchsorted(starts, bounds)
    each = [word_hashes(d) for d in data]
    return np.concatenate(each), np.concatenate(([0], np.cumsum([len(e) for e in each])))
