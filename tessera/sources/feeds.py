"""News feeds as a stream: RSS (0.9x, 1.0, 2.0) and Atom.

A poller lands each answer as a snapshot, ``<folder>/feed=<name>/poll=<number>/<file>``;
snapshots are never changed. The streaming source ``feeds`` keeps an offset per
feed, the number of its last snapshot: a micro-batch has all newer ones, dealt
to partitions of about ``PARTITION_BYTES`` and at most ``PARTITION_POLLS``
snapshots, read and parsed in their tasks. ``new_entries`` then gives every
entry of a feed once, however many snapshots repeat it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import posixpath
import re
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from email.utils import parsedate_to_datetime
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tessera.session import arrow_slices

ENTRY_SCHEMA = ("feed string, poll long, position int, format string, entry_id string, title string, link string, "
                "published timestamp, summary string, error string")
# fixed values: namespaces of the formats
ATOM = "{http://www.w3.org/2005/Atom}"
RSS1 = "{http://purl.org/rss/1.0/}"
RDF = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}"
DC = "{http://purl.org/dc/elements/1.1/}"
CONTENT = "{http://purl.org/rss/1.0/modules/content/}"
#: a partition is full at this many bytes or snapshots
PARTITION_BYTES, PARTITION_POLLS = 4 << 20, 500


def parse_time(text: str | None) -> dt.datetime | None:
    """RFC 822 and ISO 8601 times in UTC, without a zone taken as UTC; None for anything else."""
    text = (text or "").strip()
    for read in (dt.datetime.fromisoformat, parsedate_to_datetime):
        try:
            t = read(text)
            return (t if t.tzinfo else t.replace(tzinfo=dt.UTC)).astimezone(dt.UTC)
        except (ValueError, TypeError, IndexError):
            continue
    return None


def _text(item: ET.Element, *names: str) -> str | None:
    """Text of the first of these children that has any."""
    for name in names:
        for child in item.findall(name):
            text = " ".join("".join(child.itertext()).split())
            if text:
                return text
    return None


def _atom_link(entry: ET.Element) -> str | None:
    links = [(x.get("rel", "alternate"), x.get("href")) for x in entry.findall(f"{ATOM}link")]
    return next((href for rel, href in links if rel == "alternate"), links[0][1] if links else None)


def parse_feed(document: bytes) -> tuple[str, list[dict]]:
    """(format, entries in document order). An entry's id is its ``guid`` or
    ``id``, else its link, else a digest of title and time. ValueError for
    documents that are no feed."""
    try:
        root = ET.fromstring(document)
    except ET.ParseError as e:
        raise ValueError(f"not XML: {e}") from e
    if root.tag == f"{ATOM}feed":
        fmt, items = "atom", root.findall(f"{ATOM}entry")
        read = lambda x: (_text(x, f"{ATOM}id"), _text(x, f"{ATOM}title"), _atom_link(x), _text(x, f"{ATOM}published", f"{ATOM}updated"), _text(x, f"{ATOM}summary", f"{ATOM}content"))
    elif root.tag == "rss":
        fmt, items = "rss", root.findall("channel/item")
        read = lambda x: (_text(x, "guid"), _text(x, "title"), _text(x, "link"), _text(x, "pubDate", f"{DC}date"), _text(x, "description", f"{CONTENT}encoded"))
    elif root.tag == f"{RDF}RDF":
        fmt, items = "rss1", root.findall(f"{RSS1}item")
        read = lambda x: (x.get(f"{RDF}about"), _text(x, f"{RSS1}title"), _text(x, f"{RSS1}link"), _text(x, f"{DC}date"), _text(x, f"{RSS1}description"))
    else:
        raise ValueError(f"no feed: root element {root.tag}")
    entries = []
    for item in items:
        key, title, link, when, summary = read(item)
        key = key or link or hashlib.sha256(f"{title}\n{when}".encode()).hexdigest()
        entries.append({"entry_id": key, "title": title, "link": link, "published": parse_time(when), "summary": summary})
    return fmt, entries


def _store(path: str):
    """(file system, path in it)"""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*://", path) else (fs.LocalFileSystem(), re.sub("^file:", "", path))


#: the feed without a name
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def land(answers: DataFrame, folder: str) -> None:
    """Lands answers ``(feed, poll, document)`` as snapshots, each written by
    its task under a hidden name and then moved: whole or not there, and the
    same file when the task is repeated."""
    folder = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for b in arrow_slices(batches):
            for feed, poll, document in zip(*[c.to_pylist() for c in b.columns]):
                place = f"{root}/feed={NO_NAME if feed is None else quote(feed, safe='')}/poll={poll}"
                store.create_dir(place)
                draft = f"{place}/.{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as f:
                    f.write((document or "").encode())
                store.move(draft, f"{place}/answer.xml")
        yield from ()

    answers.select("feed", "poll", "document").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


class _Polls(InputPartition):
    """Snapshots (feed, poll, files) that one task reads."""

    def __init__(self, polls: list[tuple[str, int, list[str]]]):
        self.polls = polls


class FeedReader(DataSourceStreamReader):
    """Offsets ``{feed: number of its last snapshot}``."""

    def __init__(self, path: str):
        self._path = path.rstrip("/")

    def _snapshots(self) -> dict[str, dict[int, list[tuple[str, int]]]]:
        """By feed and poll: (path, size) of its files."""
        from pyarrow import fs

        store, root = _store(self._path)
        found: dict[str, dict[int, list[tuple[str, int]]]] = {}
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            m = re.search(r"/feed=([^/]+)/poll=(\d+)/([^/._][^/]*)$", info.path)
            if m and info.is_file:
                found.setdefault(m[1], {}).setdefault(int(m[2]), []).append((info.path, info.size or 0))
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {feed: max(polls) for feed, polls in self._snapshots().items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        found = self._snapshots()
        parts, polls, held = [], [], 0
        for feed, last in sorted(end.items()):
            for n, files in sorted(found.get(feed, {}).items()):
                if not start.get(feed, -1) < n <= last:
                    continue
                size = sum(s for _, s in files)
                if polls and (held + size > PARTITION_BYTES or len(polls) >= PARTITION_POLLS):
                    parts.append(_Polls(polls))
                    polls, held = [], 0
                polls.append((feed, n, sorted(p for p, _ in files)))
                held += size
        return [*parts, _Polls(polls)]

    def read(self, partition: _Polls) -> Iterator[tuple]:
        store, _ = _store(self._path)
        for name, poll, files in partition.polls:
            feed, at = unquote(name), 0
            for path in files:
                with store.open_input_stream(path) as f:
                    document = f.read()
                if not document.strip():
                    continue
                try:
                    fmt, entries = parse_feed(document)
                except ValueError as e:
                    yield (feed, poll, None, None, None, None, None, None, None, f"{posixpath.basename(path)}: {e}")
                    continue
                for x in entries:
                    yield (feed, poll, at, fmt, x["entry_id"], x["title"], x["link"], x["published"], x["summary"], None)
                    at += 1

    def commit(self, end: dict) -> None:
        pass


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return ENTRY_SCHEMA

    def streamReader(self, schema: StructType) -> FeedReader:
        return FeedReader(self.options["path"])


def feed_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the entries of all snapshots that land under ``folder``, repeated ones included; a snapshot that is no feed is a row with ``error``."""
    spark.dataSource.register(FeedSource)
    return spark.readStream.format("feeds").option("path", folder).load()


def new_entries(spark: SparkSession, folder: str, target: str, checkpoint: str) -> DataFrame:
    """Polls once: takes the snapshots that have landed since the last run with
    this target and checkpoint, and returns the entries that are new by it. The
    target keeps every entry of a feed once, as it was first seen."""
    from pyspark.sql import functions as F

    from tessera.sources.versioned import VersionedTable

    table = VersionedTable.open(spark, target, ENTRY_SCHEMA, ["feed", "entry_id"])
    before = table.version

    def store(batch: DataFrame, batch_id: int) -> None:
        good = batch.where("error IS NULL")
        row = F.struct(*[F.col(c) for c in batch.columns])
        first = good.groupBy(F.col("feed").alias("_f"), F.col("entry_id").alias("_e")).agg(F.min_by(row, F.struct("poll", "position")).alias("r")).select("r.*")
        held = table.read().select(F.col("feed").alias("_f"), F.col("entry_id").alias("_e"))
        new = first.join(held, (F.col("feed") == F.col("_f")) & (F.col("entry_id") == F.col("_e")), "left_anti")
        table.append(new, writer=(checkpoint, batch_id))

    q = feed_entries(spark, folder).writeStream.option("checkpointLocation", checkpoint).foreachBatch(store).trigger(availableNow=True).start()
    q.awaitTermination()
    after, old = table.read(), table.read(before).select(F.col("feed").alias("_f"), F.col("entry_id").alias("_e"))
    return after.join(old, (F.col("feed") == F.col("_f")) & (F.col("entry_id") == F.col("_e")), "left_anti")


