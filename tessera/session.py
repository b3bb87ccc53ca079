"""Session, table loading and lineage helpers.

Everything here is plain Spark configuration. On a cluster the session is
handed to us already configured; ``get_session`` is for tests, the bench and
local runs only.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(cores: int | str = "*", app: str = "tessera",
                shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """A local session with the settings the library assumes.

    AQE stays on so that shuffle partition counts are coalesced at run time
    and skewed join partitions are split; the static partition count is only
    the upper bound AQE starts from.
    """
    n = shuffle_partitions or (os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names; set one only if unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only a local session without the setting (tests, bench) gets
    a fresh scratch folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint folder.

    Used by iterative jobs so that each round starts from stored data and a
    lost executor does not replay every earlier round.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)


#: rows of an Arrow batch that a task turns into Python objects at once
SLICE_ROWS = 256


def arrow_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of ``rows`` (no copies): what a task holds in
    Python objects does not grow with the batches that Spark sends."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ensure_parallel(df: DataFrame) -> DataFrame:
    """Spread rows over at least ``defaultParallelism`` tasks before heavy
    per-row work (tokenizing, Python batches).

    Only when the input has fewer partitions than that (a small or
    single-row-group file); a large input already has more splits than cores
    and is left alone, so no shuffle is added at scale.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
