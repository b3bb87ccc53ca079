"""Moving a vector table into another model's space, range by range.

The table of the new vectors is the ledger: each range of keys is one commit,
named by the job and the range, so a range is done once however often the job
is started, and a job that ended goes on where it stopped. Ranges are shares of
the hashed id; their number bounds what one commit holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.vectors import cosine, project
from tessera.sources.versioned import VersionedTable

#: share of the ids, by hash and seed, on which retention is measured
SAMPLE_SHARE = 0.1


class Migration:
    """``run`` a job, or go on with it; ``status`` tells how far it is.

    ``truth`` holds ``id`` and ``target``, vectors of the new model for some
    ids; retention is the mean cosine of projected and true vectors over a
    sample by hash of the id, the same for every run with the same seed.
    """

    def __init__(self, source: DataFrame, matrix: np.ndarray, target: VersionedTable, job: str, ranges: int = 16,
                 truth: DataFrame | None = None, vec_col: str = "embedding", seed: int = 1):
        if ranges < 1:
            raise ValueError("a job has one range at least")
        self._source, self._matrix, self._target, self._vec = source, np.asarray(matrix, dtype=np.float64), target, vec_col
        self._truth, self._seed, self.job, self.ranges = truth, seed, job, ranges

    def _writer(self, i: int) -> str:
        return f"migrate/{self.job}/{i} of {self.ranges}"

    def done(self) -> list[int]:
        """Ranges that the ledger has."""
        writers = self._target.manifest()["writers"]
        return [i for i in range(self.ranges) if self._writer(i) in writers]

    def run(self, stop_after: int | None = None) -> list[int]:
        """Moves the ranges that are not done, ``stop_after`` of them at most; returns those."""
        ran = []
        for i in sorted(set(range(self.ranges)) - set(self.done())):
            if stop_after is not None and len(ran) >= stop_after:
                break
            rows = self._source.where(F.pmod(F.xxhash64("id"), F.lit(self.ranges)) == i).select("id", F.col(self._vec).alias("_v"))
            moved = project(rows, self._matrix, vec_col="_v", out="embedding").select("id", "embedding")
            self._target.upsert(moved, writer=(self._writer(i), 0))
            ran.append(i)
        return ran

    def status(self) -> DataFrame:
        """One row: job, state, progress, n_total, n_projected, sample_retention (null without truth)."""
        done = self.done()
        place = F.pmod(F.xxhash64("id"), F.lit(self.ranges))
        inside = place.isin(done) if done else F.lit(False)
        counts = self._source.agg(F.count(F.lit(1)).alias("n_total"), F.sum(F.when(inside, 1).otherwise(0)).alias("n_projected"))
        sampled = F.pmod(F.xxhash64(F.lit(self._seed), "id"), F.lit(1_000_000)) < int(SAMPLE_SHARE * 1_000_000)
        if self._truth is not None:
            pairs = self._target.read().where(sampled).join(self._truth.select("id", "target"), "id")
            counts = counts.join(pairs.agg(F.avg(cosine(F.col("embedding"), F.col("target"))).alias("sample_retention")).withColumn("_k", F.lit(1)), F.lit(1) == F.col("_k"), "left").drop("_k")
        else:
            counts = counts.withColumn("sample_retention", F.lit(None).cast("double"))
        state = "done" if len(done) == self.ranges else "running" if done else "queued"
        return counts.select(F.lit(self.job).alias("job"), F.lit(state).alias("state"), F.lit(len(done) / self.ranges).alias("progress"), "n_total", "n_projected", "sample_retention")
