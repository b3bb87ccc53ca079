"""WARC archives: a writer of one gzip member per record and a sequential reader.

Spark's text sink writes the members to any store that Spark writes to; its
commit protocol keeps the archives whole when executors are lost. The sink ends
each row with a separator, which here is the zero byte that a member ends with
anyway (the high byte of its length), so an archive is its members one after
the other, as any reader of gzip expects. The reader takes each archive in order: incremental inflation of one
member at a time, header lines, a block of ``Content-Length`` bytes, and the
SHA-256 of block and payload against the record's digests.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: payloads shorter than this are never revisits
MIN_SHARED_BYTES = 100
#: bytes of payload in one archive, about
ARCHIVE_BYTES = 8 << 20
#: bytes given to the inflater at once
STEP = 1 << 16
#: records that a task hands over at once
SLICE = 200
#: capture time of records without one of their own
NO_DATE = "1970-01-01T00:00:00Z"

READ_BACK = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to`` per page.

    Reads ``page_id, url, html``; other columns are ignored. A null html is an
    empty payload. Of equal payloads of ``MIN_SHARED_BYTES`` or more, that of
    the smallest page_id is the response (a null page_id only if no other has
    one; rows that repeat a page_id are all responses), others revisit it.
    """
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2(F.col("html"), 256)).withColumn("bytes", F.octet_length("html").cast("long"))
    shared = p.where(F.col("bytes") >= MIN_SHARED_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_id")
    p = p.join(shared, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.select("page_id", "url", F.encode("html", "utf-8").alias("payload"), "digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first_id")).alias("refers_to"))


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def gzip_member(parts: Iterable[bytes]) -> bytes:
    out = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return b"".join([*map(out.compress, parts), out.flush()])


def record_member(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record as a gzip member. A revisit has no block; its headers
    hold the payload's length and digest."""
    block = payload if kind == "response" else b""
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {NO_DATE}",
        f"WARC-Target-URI: {''.join(url.split())}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return gzip_member(("\r\n".join(head).encode() + b"\r\n\r\n", block, b"\r\n\r\n"))


def without_last_zero(member: bytes) -> bytes:
    """``member`` up to the zero byte at its end. The last byte is the high
    byte of the record's length; where it isn't zero (16 MB and more), an empty
    member, which ends with one, follows."""
    return (member if member.endswith(b"\0") else member + gzip_member(()))[:-1]


def write_archives(records: DataFrame, folder: str) -> None:
    """Write the records as archives of about ``ARCHIVE_BYTES`` of payload at
    most on average, in the partitions that they come in. A longer record is in
    an archive with others or alone, never cut."""
    sums = records.agg(F.sum(F.octet_length("payload")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    per_file = max(1, int(sums["n"]) * ARCHIVE_BYTES // max(1, int(sums["b"] or 0)))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns))
                yield pa.RecordBatch.from_arrays([pa.array([without_last_zero(record_member(*r)) for r in rows], pa.binary())], ["member"])

    (records.select("page_id", "url", "payload", "digest", "record_type", "refers_to").mapInArrow(members, "member binary")
     .select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", "\u0000").option("maxRecordsPerFile", per_file).text(folder))


class BadRecord(ValueError):
    """An archive breaks the format, or a digest doesn't match."""


def members_of(data: bytes, step: int = STEP) -> Iterator[bytes]:
    """Inflated gzip members of an archive, one at a time; empty members and
    zero padding between members are skipped. A cut or damaged member raises ``BadRecord``."""
    at, view = 0, memoryview(data)
    while True:
        while at < len(view) and view[at] == 0:
            at += 1
        if at == len(view):
            return
        inflate, parts = zlib.decompressobj(16 + zlib.MAX_WBITS), []
        try:
            while not inflate.eof:
                if at == len(view):
                    raise BadRecord("the archive ends inside a member")
                piece = view[at:at + step]
                parts.append(inflate.decompress(piece))
                at += len(piece) - len(inflate.unused_data)
        except zlib.error as e:
            raise BadRecord(str(e)) from e
        member = b"".join(parts)
        if member:
            yield member


def read_record(member: bytes) -> dict:
    """Headers and block of one record, framed by its Content-Length and
    checked against its digests."""
    end = member.find(b"\r\n\r\n")
    if end < 0:
        raise BadRecord("no end of headers")
    first, *lines = member[:end].decode().split("\r\n")
    if first != VERSION:
        raise BadRecord(f"version {first!r}")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    size = int(head["Content-Length"])
    block = member[end + 4:end + 4 + size]
    if len(block) != size or member[end + 4 + size:] != b"\r\n\r\n":
        raise BadRecord("Content-Length doesn't frame the block")
    digest = hashlib.sha256(block).hexdigest()
    if head["WARC-Block-Digest"] != f"sha256:{digest}":
        raise BadRecord("block digest")
    if head["WARC-Type"] == "response" and (head["WARC-Payload-Digest"] != f"sha256:{digest}" or int(head["X-Payload-Length"]) != size):
        raise BadRecord("payload digest")
    return head | {"block": block}


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives in a folder: ``page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, payload`` (null for revisits).
    An archive is read by one task and holds about ``ARCHIVE_BYTES``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x) if x else None
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for member in members_of(data.as_buffer()):
                    r = read_record(member)
                    rows.append({"page_id": number(r["X-Page-ID"]), "url": r["WARC-Target-URI"], "record_type": r["WARC-Type"],
                                 "payload_bytes": int(r["X-Payload-Length"]),
                                 "payload_digest": r["WARC-Payload-Digest"].removeprefix("sha256:"),
                                 "refers_to": number(r.get("X-Refers-To-Page", "")),
                                 "payload": r["block"] if r["WARC-Type"] == "response" else None})
                    if len(rows) == SLICE:
                        yield pa.RecordBatch.from_pylist(rows, READ_BACK)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, READ_BACK)

    archives = spark.read.format("binaryFile").load(folder).select("content")
    return archives.mapInArrow(records, "page_id long, url string, record_type string, payload_bytes long, "
                                         "payload_digest string, refers_to long, payload binary")
