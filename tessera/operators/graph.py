"""Graph-table audits: nodes ``(graph, id, type)`` and edges ``(graph,
source, target)`` as DataFrames.

Layers are peeled round by round; cycles are strongly connected components,
found by walks of doubled length. Each round is a few joins over the shrinking
remainder; lineage is cut every round with a reliable checkpoint into the
cluster's checkpoint folder so that a lost executor never replays earlier rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

G = "graph"


def duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """Node ids that occur more than once in a graph."""
    return nodes.groupBy(G, "id").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def dangling_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose source or target is not a node of the graph; ``side`` says which."""
    n = nodes.select(G, "id").distinct()
    src = edges.join(n.withColumnRenamed("id", "source"), on=[G, "source"], how="left_anti") \
        .withColumn("side", F.lit("source"))
    tgt = edges.join(n.withColumnRenamed("id", "target"), on=[G, "target"], how="left_anti") \
        .withColumn("side", F.lit("target"))
    return src.unionByName(tgt)


def disconnected_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes in no edge, in graphs with more than one node."""
    ends = edges.select(G, F.col("source").alias("id")).unionByName(
        edges.select(G, F.col("target").alias("id"))).distinct()
    multi = nodes.groupBy(G).agg(F.count_distinct("id").alias("_n")).filter(F.col("_n") > 1).select(G)
    return nodes.join(multi, on=G, how="left_semi").join(ends, on=[G, "id"], how="left_anti")


def restricted_nodes(nodes: DataFrame, types: Sequence[str]) -> DataFrame:
    """Nodes of any of the listed types (a short config list: an ``IN`` filter)."""
    return nodes.filter(F.col("type").isin(list(types)))


def port_mismatch(edges: DataFrame, ports: DataFrame) -> DataFrame:
    """Edges whose source port type and target port type differ."""
    p = ports.select(G, "id", "type")
    j = edges.join(p.select(G, F.col("id").alias("source"), F.col("type").alias("source_type")),
                   on=[G, "source"]) \
        .join(p.select(G, F.col("id").alias("target"), F.col("type").alias("target_type")),
              on=[G, "target"])
    return j.filter(~F.col("source_type").eqNullSafe(F.col("target_type")))


def topo_layers(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Kahn layering: layer 0 = no incoming edge; a node gets layer r when
    all its predecessors were peeled in earlier rounds. Nodes on or after a
    cycle keep ``layer = null``. Edges to unknown nodes are ignored.

    Rounds go on until nothing can be peeled. Each round stores its own layer
    once; the layers are read together at the end.

    Returns ``(graph, id, layer)``.
    """
    n = nodes.select(G, "id").distinct()
    e = edges.select(G, "source", "target").distinct() \
        .join(n.withColumnRenamed("id", "source"), on=[G, "source"], how="left_semi") \
        .join(n.withColumnRenamed("id", "target"), on=[G, "target"], how="left_semi")
    remaining = cut_lineage(n)
    live_edges = cut_lineage(e)
    layers: list[DataFrame] = []
    while True:
        has_in = live_edges.select(G, F.col("target").alias("id")).distinct()
        peel = cut_lineage(remaining.join(has_in, on=[G, "id"], how="left_anti").withColumn("layer", F.lit(len(layers))))
        if peel.isEmpty():
            break
        layers.append(peel)
        remaining = cut_lineage(remaining.join(peel.select(G, "id"), on=[G, "id"], how="left_anti"))
        live_edges = cut_lineage(live_edges.join(peel.select(G, F.col("id").alias("source")),
                                                 on=[G, "source"], how="left_anti"))
    # what is left lies on or behind a cycle
    return reduce(DataFrame.unionByName, layers, remaining.withColumn("layer", F.lit(None).cast("int")))


#: walks of doubled length are kept while they are at most so many times the edges (and this many rows)
WALK_FACTOR, WALK_ROWS = 4, 100_000


def _ends(walks: DataFrame, side: str) -> DataFrame:
    return walks.select(G, F.col(side).alias("id")).distinct()


def _inside(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    return edges.join(nodes.withColumnRenamed("id", "source"), [G, "source"], "left_semi").join(nodes.withColumnRenamed("id", "target"), [G, "target"], "left_semi")


def _twice(walks: DataFrame) -> DataFrame:
    """Walks of twice the length: one after the other."""
    then = walks.select(G, F.col("source").alias("target"), F.col("target").alias("_to"))
    return walks.join(then, [G, "target"]).select(G, "source", F.col("_to").alias("target")).distinct()


def _lasting(nodes: DataFrame, edges: DataFrame, sides: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes from which walks without end go on: against the edges for side
    ``target`` (they lie on or behind a cycle), along them for ``source`` (on or
    before one). Returns them, with the edges among them.

    A node without a walk of length 1, 2, 4, ... falls away, so a chain goes in
    as many rounds as its length has binary digits. Walks that grow too many
    (wide graphs, which are seldom deep) start again from the edges that are left.
    """
    nodes, edges = cut_lineage(nodes), cut_lineage(edges)
    walks, left = edges, nodes.count()
    while left:
        keep = nodes
        for side in sides:
            keep = keep.join(_ends(edges, side), [G, "id"], "left_semi")
            if walks is not edges:
                keep = keep.join(_ends(walks, side), [G, "id"], "left_semi")
        keep = cut_lineage(keep)
        n = keep.count()
        same, nodes, left = n == left, keep, n
        if same and walks is edges:
            break  # every node has an edge among those left
        if same:
            walks = edges  # check by single steps
            continue
        edges = cut_lineage(_inside(edges, nodes))
        longer = cut_lineage(_twice(_inside(walks, nodes)))
        walks = longer if longer.count() <= max(WALK_ROWS, WALK_FACTOR * edges.count()) else edges
    return nodes, cut_lineage(_inside(edges, nodes))


def _spread(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The largest label among each node's own and those of all nodes that
    reach it: labels move along walks of length 1, 2, 4, ..., and along single
    edges until nothing changes where walks grow too many."""
    labels, walks = cut_lineage(labels), edges
    doubling, bound = True, max(WALK_ROWS, WALK_FACTOR * edges.count())
    seen = None
    while True:
        got = walks.join(labels.withColumnRenamed("id", "source"), [G, "source"]).select(G, F.col("target").alias("id"), "label")
        new = cut_lineage(labels.unionByName(got).groupBy(G, "id").agg(F.max("label").alias("label")))
        now = new.agg(F.bit_xor(F.xxhash64(G, "id", "label"))).first()[0]
        changed, seen, labels = now != seen, now, new
        if doubling:
            longer = cut_lineage(_twice(walks))
            rows = longer.count()
            if rows == 0:
                return labels
            doubling = rows <= bound
            walks = longer if doubling else edges
            if not changed and doubling:  # nothing came over the longer way: check by single steps
                doubling, walks = False, edges
        elif not changed:
            return labels


def strong_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that lie on a cycle, ``(graph, id, component, size)``; a component
    is named by one of its nodes. Edges to unknown nodes are ignored.

    Nodes before and behind all cycles are trimmed. Of the rest every node
    takes the largest of the (hashed) labels that reach it; the nodes of a
    colour that lead back to its owner are the owner's component. They go,
    edges between colours go, and the rest is trimmed again. Labels are hashed
    anew each time, so cycles in a row need about as many rounds as their number
    has binary digits.
    """
    n = nodes.select(G, "id").distinct()
    e = cut_lineage(_inside(edges.select(G, "source", "target").distinct(), n))
    both = ("target", "source")
    live, e = _lasting(n, e, both)
    found, turn = [], 0
    while not live.isEmpty():
        own = F.struct(F.xxhash64(F.lit(turn), G, "id").alias("h"), F.col("id").alias("id"))
        colours = _spread(live.select(G, "id", own.alias("label")), e)
        colour = lambda side: colours.select(G, F.col("id").alias(side), F.col("label.id").alias(f"{side}_colour"))
        within = cut_lineage(e.join(colour("source"), [G, "source"]).join(colour("target"), [G, "target"]).where("source_colour = target_colour").select(G, "source", "target"))
        back = within.select(G, F.col("target").alias("source"), F.col("source").alias("target"))
        marks = _spread(colours.select(G, "id", (F.col("id") == F.col("label.id")).alias("label")), back)
        mine = cut_lineage(marks.where("label").select(G, "id").join(colours.select(G, "id", F.col("label.id").alias("component")), [G, "id"]))
        found.append(mine)
        rest = live.join(mine.select(G, "id"), [G, "id"], "left_anti")
        live, rest_edges = _lasting(rest, _inside(within, rest), both)
        e, turn = rest_edges, turn + 1
    if not found:
        return n.limit(0).select(G, "id", F.col("id").alias("component"), F.lit(0).cast("long").alias("size"))
    parts = reduce(DataFrame.unionByName, found)
    sizes = parts.groupBy(G, "component").agg(F.count(F.lit(1)).alias("size"))
    loops = edges.where(F.col("source") == F.col("target")).select(G, F.col("source").alias("id")).distinct()
    # a node alone is on a cycle only with an edge to itself
    return parts.join(sizes, [G, "component"]).join(loops.withColumn("_loop", F.lit(True)), [G, "id"], "left").where("size > 1 OR _loop").select(G, "id", "component", "size")


def cyclic_graphs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Graphs with a cycle: nodes on cycles, nodes on or behind one (those that
    peeling never reaches), and the number of separate knots of cycles.
    ``finished`` is always true: nothing is left undecided."""
    n = nodes.select(G, "id").distinct()
    stuck, _ = _lasting(n, _inside(edges.select(G, "source", "target").distinct(), n), ("target",))
    on = strong_components(stuck, edges)
    per = on.groupBy(G).agg(F.count(F.lit(1)).alias("cycle_nodes"), F.count_distinct("component").alias("knots"))
    return stuck.groupBy(G).agg(F.count(F.lit(1)).alias("stuck_nodes")).join(per, G).withColumn("finished", F.lit(True))


def cycle_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every node on or behind a cycle; ``on_cycle`` tells which, ``component``
    names the knot of cycles that a node lies on."""
    n = nodes.select(G, "id").distinct()
    stuck, _ = _lasting(n, _inside(edges.select(G, "source", "target").distinct(), n), ("target",))
    on = strong_components(stuck, edges)
    return stuck.join(on, [G, "id"], "left").select(G, "id", F.col("component").isNotNull().alias("on_cycle"), "component", "size")
