"""Connected components of an edge table, as Spark jobs.

Alternating large-star and small-star rounds: each round every node's
neighbours are linked to the smallest of them. Rounds are cut by reliable
checkpoints and end when the edges stop changing; nothing but two sums per
round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``m``, the smallest of u and all its v; a hot u is
    aggregated before the shuffle and its join is split by Spark."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    t = _to_smallest(down)
    return t.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(t.select("u", F.col("m").alias("v")))


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns of one orderable
    type): the root is the smallest node of its component, and is not listed
    itself as a node. Self-edges and repeated edges don't matter, edges with a
    null are ignored; no edges give no rows."""
    a, b = edges.columns
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    e = cut_lineage(_distinct(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    state = _state(e)
    while state[0]:
        e = cut_lineage(_distinct(_small_star(_distinct(_large_star(e)))))
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
