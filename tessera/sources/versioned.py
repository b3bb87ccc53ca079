"""A keyed table in a folder: Parquet rows in buckets of their document, and
one small manifest per version.

* A **document** is the set of rows that share the ``by`` columns; its bucket
  is a hash of them. An upsert replaces documents whole, so a shorter version
  leaves none of its old rows behind.
* An upsert writes its rows once. Only buckets that hold an old row of one of
  its documents are rewritten; the others get a further folder.
* Deletes are key files that hide older rows until their bucket is rewritten.
* A version is the list of live folders per bucket. It becomes current by the
  creation of its manifest, the last step of a commit: a commit that fails
  leaves the version before readable, and two commits from the same version
  cannot both succeed. Readers of a version keep their files until ``vacuum``.
* A commit may carry a transaction number of its writer; one that is not above
  the last is skipped, so a repeated micro-batch changes nothing.

All paths go through Hadoop's file system, so any store that Spark reads will
do. What the driver holds is the manifest: folders per bucket, no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, SEQ = "_bucket", "_seq"
#: folders of a bucket from which on an upsert rewrites it
MAX_FOLDERS = 16


class Conflict(RuntimeError):
    """Another writer made this version first."""


class Folder:
    """A folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file, whole or not at all; Conflict if the name is taken."""
        draft = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        out = self._fs.create(self._at(draft), False)
        out.write(text.encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        modes = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(self._at(draft)), self._fs.makeQualified(self._at(name)), modes)
        except Exception as e:
            self._fs.delete(self._at(draft), False)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(name) from e
            raise

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _manifest_name(version: int) -> str:
    return f"_manifest/{version:012d}.json"


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


class VersionedTable:
    """See the module. ``create`` or ``open`` gives one; rows are read with
    ``read``, written with ``upsert``, ``append`` and ``delete``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)
        self.path = self.folder.path
        if not self._versions():
            raise FileNotFoundError(f"no table at {path}")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType | str, by: str | Sequence[str], buckets: int = 16,
               place: Sequence[str] | None = None) -> VersionedTable:
        """An empty table with the columns of ``schema`` (a struct, or DDL). Buckets
        go by the columns ``place``, some of ``by``; by default by all of them. An
        upsert rewrites whole buckets: take about as many as the table has gigabytes."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        by = [by] if isinstance(by, str) else list(by)
        place = list(place or by)
        missing = [c for c in by if c not in schema.fieldNames()] + [c for c in place if c not in by]
        if missing or {BUCKET, SEQ} & set(schema.fieldNames()) or buckets < 1:
            raise ValueError(f"key columns {by}, {buckets} buckets and columns {schema.fieldNames()} make no table")
        Folder(spark, path).create(_manifest_name(0), json.dumps(
            {"version": 0, "schema": schema.json(), "by": by, "place": place, "buckets": buckets, "entries": {}, "writers": {}, "commit": {"kind": "create"}}))
        return cls(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: T.StructType | str | None = None, by: str | Sequence[str] = (), buckets: int = 16) -> VersionedTable:
        """The table at ``path``; made if it does not exist and a schema is given."""
        if schema is not None and not Folder(spark, path).names("_manifest"):
            return cls.create(spark, path, schema, by, buckets)
        return cls(spark, path)

    # ------------------------------------------------------------ versions

    def _versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names("_manifest") if n.endswith(".json") and not n.startswith(".")]

    @property
    def version(self) -> int:
        return max(self._versions())

    def manifest(self, version: int | None = None) -> dict:
        return json.loads(self.folder.read(_manifest_name(self.version if version is None else version)))

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.manifest()["schema"]))

    def _commit(self, old: dict, entries: dict, commit: dict, writer: tuple[str, int] | None) -> dict:
        """Makes the next version: its manifest is created whole, and only if no other has its number."""
        entries = {b: e for b, e in entries.items() if e["data"]}
        new = old | {"version": old["version"] + 1, "entries": entries, "commit": commit}
        if writer:
            new["writers"] = old["writers"] | {writer[0]: writer[1]}
        self.folder.create(_manifest_name(new["version"]), json.dumps(new))
        return commit | {"version": new["version"]}

    def _done(self, m: dict, writer: tuple[str, int] | None) -> dict | None:
        if writer and m["writers"].get(writer[0], -1) >= writer[1]:
            return {"kind": "skipped", "version": m["version"]}
        return None

    # ------------------------------------------------------------- reading

    def _bucket_of(self, m: dict) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in m["place"]]), F.lit(m["buckets"])).cast("int")

    def _rows(self, m: dict, buckets: Iterable[str], keep_seq: bool = False) -> DataFrame:
        schema = T.StructType([*T.StructType.fromJson(json.loads(m["schema"])).fields, T.StructField(SEQ, T.LongType())])
        plain, hidden, deletes = [], [], []
        for b in buckets:
            e = m["entries"].get(b)
            if e:
                (hidden if e["deletes"] else plain).extend(e["data"])
                deletes += e["deletes"]
        load = lambda paths, s: self.spark.read.schema(s).parquet(*[f"{self.path}/{p}" for p in paths])
        rows = load(plain, schema) if plain else None
        if hidden:
            keys = T.StructType([*[schema[c] for c in m["by"]], T.StructField(SEQ, T.LongType())])
            gone = load(deletes, keys).groupBy(*m["by"]).agg(F.max(SEQ).alias("_until"))
            gone = gone.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(m["by"])], "_until")
            left = load(hidden, schema).join(gone, _same(m["by"], [f"_k{i}" for i in range(len(m["by"]))]) & (F.col(SEQ) < F.col("_until")), "left_anti")
            rows = left if rows is None else rows.unionByName(left)
        if rows is None:
            rows = self.spark.createDataFrame([], schema)
        return rows if keep_seq else rows.drop(SEQ)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the current one."""
        m = self.manifest(version)
        return self._rows(m, m["entries"])

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of the documents named by ``keys`` (the ``by`` columns, or those of ``place``); only their buckets are read."""
        m = self.manifest(version)
        named = m["by"] if set(m["by"]) <= set(keys.columns) else m["place"]
        wanted = keys.select(*named).distinct()
        buckets = [str(r[0]) for r in wanted.select(self._bucket_of(m)).distinct().collect()]  # at most a row per bucket
        k = wanted.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(named)])
        return self._rows(m, buckets).join(k, _same(named, k.columns), "left_semi")

    # ------------------------------------------------------------- writing

    def _write(self, rows: DataFrame, name: str) -> list[str]:
        """Rows into one folder per bucket; the buckets that have rows. A bucket larger than the rest is split over tasks."""
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        return [n.removeprefix(f"{BUCKET}=") for n in self.folder.names(name) if n.startswith(f"{BUCKET}=")]

    def _fitted(self, rows: DataFrame, m: dict) -> DataFrame:
        fields = T.StructType.fromJson(json.loads(m["schema"])).fields
        extra = set(rows.columns) - {f.name for f in fields}
        if extra:
            raise ValueError(f"columns {sorted(extra)} are not in the table")
        cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return rows.select(*cols, F.lit(m["version"] + 1).cast("long").alias(SEQ)).withColumn(BUCKET, self._bucket_of(m))

    def _base(self, base: int | None) -> dict:
        """The manifest that a commit builds on: the current one, or an older one (versions in between are left out)."""
        return self.manifest() if base is None else self.manifest(base) | {"version": self.version}

    def append(self, rows: DataFrame, writer: tuple[str, int] | None = None, base: int | None = None) -> dict:
        """Adds rows; nothing is rewritten and no document replaced."""
        m = self._base(base)
        if done := self._done(m, writer):
            return done
        name = f"data/{uuid.uuid4().hex}"
        added = self._write(self._fitted(rows, m), name)
        entries = {b: dict(e) for b, e in m["entries"].items()}
        for b in added:
            e = entries.setdefault(b, {"data": [], "deletes": []})
            e["data"] = [*e["data"], f"{name}/{BUCKET}={b}"]
        return self._commit(m, entries, {"kind": "append", "added": added, "rewritten": []}, writer)

    def upsert(self, rows: DataFrame, writer: tuple[str, int] | None = None, version_col: str | None = None) -> dict:
        """Replaces the documents of ``rows`` (or adds them). All rows of a
        document in ``rows`` are its new version. With ``version_col`` a
        document stays as it is if it holds a higher value than the new one."""
        m = self.manifest()
        if done := self._done(m, writer):
            return done
        by, name = m["by"], uuid.uuid4().hex
        fitted = self._fitted(rows, m)
        if version_col:
            stored = self._rows(m, m["entries"]).groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).agg(F.max(version_col).alias("_has"))
            new = fitted.groupBy(*by).agg(F.max(version_col).alias("_new"))
            stale = new.join(stored, _same(by, [f"_k{i}" for i in range(len(by))]) & (F.col("_has") > F.col("_new"))).select(*[F.col(f"_k{i}") for i in range(len(by))])
            fitted = fitted.join(stale, _same(by, stale.columns), "left_anti")
        added = self._write(fitted, f"data/{name}-new")
        touched = [b for b in added if b in m["entries"]]
        entries = {b: dict(e) for b, e in m["entries"].items()}
        rewritten: list[str] = []
        if touched:
            new = self.spark.read.schema(fitted.drop(SEQ, BUCKET).schema).parquet(*[f"{self.path}/data/{name}-new/{BUCKET}={b}" for b in touched])
            keys = new.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).distinct()
            same = _same(by, keys.columns)
            held = self._rows(m, touched, keep_seq=True).withColumn(BUCKET, self._bucket_of(m))
            # keys only: which buckets hold an old row of these documents
            rewritten = [str(r[0]) for r in held.select(*by, BUCKET).join(keys, same, "left_semi").select(BUCKET).distinct().collect()]
            rewritten = sorted({*rewritten, *(b for b in touched if len(m["entries"][b]["data"]) >= MAX_FOLDERS)}, key=int)
        if rewritten:
            held = self._rows(m, rewritten, keep_seq=True).withColumn(BUCKET, self._bucket_of(m))
            kept = self._write(held.join(keys, same, "left_anti"), f"data/{name}-kept")
            for b in rewritten:
                entries[b] = {"data": [f"data/{name}-kept/{BUCKET}={b}"] if b in kept else [], "deletes": []}
        for b in added:
            e = entries.setdefault(b, {"data": [], "deletes": []})
            e["data"] = [*e["data"], f"data/{name}-new/{BUCKET}={b}"]
        return self._commit(m, entries, {"kind": "upsert", "added": added, "rewritten": rewritten}, writer)

    def delete(self, keys: DataFrame, writer: tuple[str, int] | None = None, base: int | None = None) -> dict:
        """Hides the documents named by ``keys``; no row is rewritten."""
        m = self._base(base)
        if done := self._done(m, writer):
            return done
        name = f"deletes/{uuid.uuid4().hex}"
        rows = keys.select(*m["by"]).distinct().withColumn(SEQ, F.lit(m["version"] + 1).cast("long")).withColumn(BUCKET, self._bucket_of(m))
        touched = [b for b in self._write(rows, name) if b in m["entries"]]
        entries = {b: dict(e) for b, e in m["entries"].items()}
        for b in touched:
            entries[b]["deletes"] = [*entries[b]["deletes"], f"{name}/{BUCKET}={b}"]
        return self._commit(m, entries, {"kind": "delete", "added": touched, "rewritten": []}, writer)

    def compact(self) -> dict:
        """Rewrites the buckets that have key files or more than one folder."""
        m = self.manifest()
        due = [b for b, e in m["entries"].items() if e["deletes"] or len(e["data"]) > 1]
        entries = {b: dict(e) for b, e in m["entries"].items()}
        if due:
            name = f"data/{uuid.uuid4().hex}-compact"
            kept = self._write(self._rows(m, due, keep_seq=True).withColumn(BUCKET, self._bucket_of(m)), name)
            for b in due:
                entries[b] = {"data": [f"{name}/{BUCKET}={b}"] if b in kept else [], "deletes": []}
        return self._commit(m, entries, {"kind": "compact", "added": [], "rewritten": sorted(due, key=int)}, None)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drops all but the newest ``keep`` versions, and the folders that none
        of those names, those of failed commits included; returns them. No
        commit may run meanwhile."""
        versions = sorted(self._versions())
        kept = versions[-max(1, keep):]
        live = {p.split("/")[1] for v in kept for e in self.manifest(v)["entries"].values() for p in e["data"] + e["deletes"]}
        for v in versions[:-max(1, keep)]:
            self.folder.remove(_manifest_name(v))
        gone = [f"{kind}/{n}" for kind in ("data", "deletes") for n in self.folder.names(kind) if n not in live]
        for name in gone:
            self.folder.remove(name)
        return gone
