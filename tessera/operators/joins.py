"""Merges, keyed overlays, edge tables and evidence joins.

Spark picks the physical join. Small dimension tables (grants, names,
contracts) are broadcast only behind :func:`bounded_broadcast`, which proves
the row bound first and otherwise leaves the join to a shuffle (with AQE
skew splitting).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import positions

BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the table is proven to hold at most ``max_rows``
    rows (a ``limit(max_rows + 1).count()`` job); beyond it no hint is given
    and Spark shuffles both sides."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


# --------------------------------------------------------------------------
# merge block
# --------------------------------------------------------------------------


def merge_append(*dfs: DataFrame, source_col: str = "source_no") -> DataFrame:
    """Concatenate inputs in order; ``source_no`` keeps which input a row came from."""
    parts = [d.withColumn(source_col, F.lit(i)) for i, d in enumerate(dfs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_by_position(a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str],
                      pos_col: str = "pos") -> DataFrame:
    """Row i of ``a`` merged with row i of ``b`` (positions in the given
    orders); ``b`` wins on equal names; the longer side is kept whole."""
    pa = positions(a, [], order_a, name="_pa")
    pb = positions(b, [], order_b, name="_pb")
    j = pa.join(pb, pa["_pa"] == pb["_pb"], "full_outer")
    cols: list[Column] = [F.coalesce(F.col("_pa"), F.col("_pb")).alias(pos_col)]
    bnames = set(b.columns)
    for c in a.columns:
        if c in bnames:
            cols.append(F.when(F.col("_pb").isNotNull(), pb[c]).otherwise(pa[c]).alias(c))
        else:
            cols.append(pa[c])
    cols += [pb[c] for c in b.columns if c not in set(a.columns)]
    return j.select(*cols)


def merge_first(*dfs: DataFrame, source_col: str = "source_no") -> DataFrame:
    """The first non-empty input; the others are dropped (a scalar subquery
    picks the smallest input number that has rows)."""
    u = merge_append(*dfs, source_col=source_col)
    first = u.select(F.min(source_col)).scalar()
    return u.filter(F.col(source_col) == first)


def overlay(a: DataFrame, b: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keyed overlay: rows matched on ``key``; per field the later input wins
    where it has a value."""
    key = [key] if isinstance(key, str) else list(key)
    j = a.alias("a").join(b.alias("b"), on=key, how="full_outer")
    cols: list[Column] = [F.col(k) for k in key]
    bnames = set(b.columns)
    for c in a.columns:
        if c in key:
            continue
        cols.append(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in bnames else F.col(f"a.{c}"))
    cols += [F.col(f"b.{c}") for c in b.columns if c not in key and c not in set(a.columns)]
    return j.select(*cols)


# --------------------------------------------------------------------------
# edges
# --------------------------------------------------------------------------

EDGE_KEY = ["source", "target", "relation"]


def add_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    """Insert edges (relation default ``related_to``, weight 1); an edge that
    already exists on (source, target, relation) keeps its stored row."""
    n = new.withColumn("relation", F.coalesce(F.col("relation"), F.lit("related_to"))) \
        if "relation" in new.columns else new.withColumn("relation", F.lit("related_to"))
    n = n.withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(1.0))) \
        if "weight" in n.columns else n.withColumn("weight", F.lit(1.0))
    n = n.select("source", "target", "relation", "weight")
    e = edges.select("source", "target", "relation", F.col("weight").cast("double"))
    u = merge_append(e, n, source_col="_src")
    first = u.groupBy(*EDGE_KEY).agg(F.min_by(F.struct("weight", "_src"), F.col("_src")).alias("_r"))
    return first.select(*EDGE_KEY, F.col("_r.weight").alias("weight"),
                        (F.col("_r._src") == 1).alias("added"))


def list_edges(edges: DataFrame, node: Column | str | DataFrame | None = None, direction: str = "outgoing",
               relation: str | None = None, id_col: str = "id") -> DataFrame:
    """Edges of a node, or of every node in a node table (a semi join):
    ``outgoing``, ``incoming`` or ``both`` (tagged with ``direction``)."""
    e = edges if relation is None else edges.filter(F.col("relation") == relation)

    def sel(col: str, tag: str) -> DataFrame:
        if isinstance(node, DataFrame):
            d = e.join(node.select(F.col(id_col).alias(col)).distinct(), on=col, how="left_semi")
        elif node is None:
            d = e
        else:
            d = e.filter(F.col(col) == (F.lit(node) if isinstance(node, str) else node))
        return d.withColumn("direction", F.lit(tag))
    if direction == "outgoing":
        return sel("source", "outgoing")
    if direction == "incoming":
        return sel("target", "incoming")
    return sel("source", "outgoing").unionByName(sel("target", "incoming"))


def delete_edges(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove edges matching (source, target, relation)."""
    return edges.join(keys.select(*EDGE_KEY), on=EDGE_KEY, how="left_anti")


def expand_neighbors(hits: DataFrame, edges: DataFrame, relations: Sequence[str] | None = None,
                     direction: str = "both", cap: int = 10, id_col: str = "id",
                     by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Attach up to ``cap`` (max 100) neighbours per hit, strongest first
    (weight, then neighbour id, relation, direction).

    The cap is applied per node before the join (a window group limit,
    partial per task), so a hub node with millions of edges contributes at
    most ``cap`` rows to each of its hits.
    """
    if not 1 <= cap <= 100:
        raise ValueError("cap must be in 1..100")
    e = edges if not relations else edges.filter(F.col("relation").isin(list(relations)))
    parts = []
    if direction in ("outgoing", "both"):
        parts.append(e.select(F.col("source").alias("_node"), F.col("target").alias("nid"),
                              "relation", "weight", F.lit("outgoing").alias("direction")))
    if direction in ("incoming", "both"):
        parts.append(e.select(F.col("target").alias("_node"), F.col("source").alias("nid"),
                              "relation", "weight", F.lit("incoming").alias("direction")))
    nb = reduce(lambda a, b: a.unionByName(b), parts)
    keys = list(by) + [id_col]
    # the cap depends only on the node's own edges: keep the best ``cap`` per
    # node first (map-side window group limit), so a hub never fans out
    wn = Window.partitionBy("_node").orderBy(F.col("weight").desc(), F.col("nid"), F.col("relation"),
                                             F.col("direction"))
    nb = nb.withColumn("_rn", F.row_number().over(wn)).filter(F.col("_rn") <= cap)
    top = hits.select(*keys).join(nb, hits[id_col] == nb["_node"], "inner").drop("_node")
    agg = top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        "_rn", F.col("nid").alias("id"), "relation", "direction", "weight"))).alias("_n"))
    agg = agg.select(*keys, F.transform("_n", lambda s: s.dropFields("_rn")).alias("neighbors"))
    return hits.join(agg, on=keys, how="left").withColumn(
        "neighbors", F.coalesce(F.col("neighbors"), F.array().cast(agg.schema["neighbors"].dataType)))


#: tasks that a node with many hits is spread over
HUB_SALTS = 8


def _capped(edges: DataFrame, relations: Sequence[str] | None, direction: str, cap: int) -> DataFrame:
    """The ``cap`` strongest neighbours of every node: ``(_node, nid)``."""
    e = edges if not relations else edges.filter(F.col("relation").isin(list(relations)))
    sides = {"outgoing": [("source", "target")], "incoming": [("target", "source")], "both": [("source", "target"), ("target", "source")]}[direction]
    parts = [e.select(F.col(a).alias("_node"), F.col(b).alias("nid"), "relation", "weight", F.lit("outgoing" if a == "source" else "incoming").alias("direction")) for a, b in sides]
    w = Window.partitionBy("_node").orderBy(F.col("weight").desc(), F.col("nid"), F.col("relation"), F.col("direction"))
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).select("_node", "nid").distinct()


def _salted(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(HUB_SALTS)).cast("int"))


def _copies(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(HUB_SALTS)])))


def expand_hops(hits: DataFrame, edges: DataFrame, hops: int = 2, relations: Sequence[str] | None = None, direction: str = "both",
                cap: int = 10, id_col: str = "id", by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Nodes within ``hops`` steps of each query's hits: ``(*by, id, hop)``, the
    fewest steps (0 for the hits themselves).

    From a node a step goes to its ``cap`` strongest neighbours. A node is
    visited once for a query, so the frontier holds new nodes alone and a walk in
    circles ends. The cap is applied before any join, and rows that ask for the
    same node are spread over ``HUB_SALTS`` tasks, so neither a hub's edges nor a
    node that many queries hit pile up in one task.
    """
    from tessera.session import cut_lineage

    if not 1 <= cap <= 100 or hops < 0:
        raise ValueError("cap must be in 1..100, hops not negative")
    near = _capped(edges, relations, direction, cap)
    if hops > 1:
        near = cut_lineage(near)
    seen = cut_lineage(hits.select(*by, F.col(id_col).alias("id")).distinct().withColumn("hop", F.lit(0)))
    front = seen
    for hop in range(1, hops + 1):
        asked = near.join(front.select("id").distinct(), F.col("_node") == F.col("id"), "left_semi")
        step = _salted(front.select(*by, F.col("id").alias("_node")), by).join(_copies(asked), ["_node", "_salt"])
        new = step.select(*by, F.col("nid").alias("id")).distinct().join(seen.select(*by, "id"), [*by, "id"], "left_anti")
        front = cut_lineage(new.withColumn("hop", F.lit(hop)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def hit_subgraph(hits: DataFrame, edges: DataFrame, id_col: str = "id",
                 by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Edges whose two ends are both among a query's hits. Hits of the same
    node, and a hub's edges, are spread over ``HUB_SALTS`` tasks."""
    h = hits.select(*by, F.col(id_col).alias("_id")).distinct()
    own = _copies(_salted(h, by).withColumnRenamed("_salt", "_q").withColumnRenamed("_id", "source"))
    e = edges.join(h.select(F.col("_id").alias("source")).distinct(), "source", "left_semi").join(h.select(F.col("_id").alias("target")).distinct(), "target", "left_semi")
    # a hub's edges by their other end, its hits by copies for each of those shares
    j = _salted(e, ["target"]).join(own.drop("_q"), ["source", "_salt"]).drop("_salt")
    return j.join(h.withColumnRenamed("_id", "target"), on=[*by, "target"], how="left_semi").select(*by, *edges.columns)


_HEX32 = "^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"


def resolve_keys(df: DataFrame, col: str, dim: DataFrame, name_col: str = "name",
                 id_col: str = "id", out: str = "resolved_id") -> DataFrame:
    """A value of 32 hex digits (dashes allowed) is an id, dashes removed;
    anything else is looked up by name; ``unresolved`` marks the rest."""
    is_id = F.regexp_like(F.col(col), F.lit(_HEX32))
    d = bounded_broadcast(dim.select(F.col(name_col).alias("_name"), F.col(id_col).alias("_id")))
    j = df.join(d, (~is_id) & (F.col(col) == F.col("_name")), "left")
    return j.withColumn(out, F.when(is_id, F.regexp_replace(F.col(col), "-", "")).otherwise(F.col("_id"))) \
        .withColumn("unresolved", F.col(out).isNull()).drop("_name", "_id")


def pair_calls(events: DataFrame, run_col: str = "run_id", call_col: str = "call_id",
               ts_col: str = "ts") -> DataFrame:
    """Tool calls with their results on (run, call id); unmatched rows are
    kept on both sides (a refused call logs a result without a call)."""
    calls = events.filter(F.col("type") == "tool_call").select(
        run_col, call_col, F.col("tool_name").alias("tool"), F.col(ts_col).alias("call_ts"))
    res = events.filter(F.col("type") == "tool_result").select(
        run_col, call_col, F.col(ts_col).alias("result_ts"), F.col("result"))
    j = calls.join(res, on=[run_col, call_col], how="full_outer")
    return j.withColumn("duration_s", F.round(
        (F.unix_micros(F.col("result_ts").cast("timestamp")) - F.unix_micros(F.col("call_ts").cast("timestamp"))) / 1e6, 6))


def judge(hits: DataFrame, qrels: DataFrame, query_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """Ranked hits joined to relevance lists; ``qrels`` is
    ``(query_id, doc_ids array)`` or ``(query_id, doc_id)``."""
    from pyspark.sql import types as T

    q = qrels
    if isinstance(q.schema[q.columns[1]].dataType, T.ArrayType):
        q = q.select(F.col(q.columns[0]).alias(query_col), F.explode(q.columns[1]).alias(id_col))
    else:
        q = q.select(F.col(q.columns[0]).alias(query_col), F.col(q.columns[1]).alias(id_col))
    q = q.distinct().withColumn("relevant", F.lit(True))
    return hits.join(q, on=[query_col, id_col], how="left").withColumn(
        "relevant", F.coalesce(F.col("relevant"), F.lit(False)))


def gather_results(df: DataFrame, by: Sequence[str] = ("question",), url_col: str = "url",
                   order_by: Sequence[str] = ("iteration", "query_no", "pos")) -> DataFrame:
    """Results of many searches, first seen per URL (a partial ``min_by``)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    g = df.groupBy(*by, url_col).agg(F.min_by(row, F.struct(*[F.col(c) for c in order_by])).alias("_r"))
    return g.select("_r.*")


def session_turns(conv: DataFrame, n: int, session_col: str = "conv_id", turn_col: str = "turn",
                  text_col: str = "text", role_col: str = "role") -> DataFrame:
    """The last ``n`` turns of each session, oldest first, as one text per
    session (``role: text`` lines). The list is bounded by ``n``."""
    w = Window.partitionBy(session_col).orderBy(F.col(turn_col).desc())
    last = conv.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    g = last.groupBy(session_col).agg(F.array_sort(F.collect_list(F.struct(
        F.col(turn_col).alias("t"), F.concat(F.col(role_col), F.lit(": "), F.col(text_col)).alias("line")))).alias("_l"))
    return g.select(session_col, F.array_join(F.transform("_l", lambda s: s["line"]), "\n").alias("history"),
                    F.size("_l").alias("n_turns"))


def recent_turns(conv: DataFrame, n: int, budget: int, session_col: str = "conv_id", turn_col: str = "turn",
                 text_col: str = "text", role_col: str = "role") -> DataFrame:
    """The newest turns of each session, ``n`` at most, that fit whole into a
    token budget (4 characters a token): ``turns`` (role, content), oldest
    first, ``turns_text`` (``role: content`` lines) and the tokens ``spent`` on
    it with the blank line behind it."""
    new = Window.partitionBy(session_col).orderBy(F.col(turn_col).desc())
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    last = conv.select(session_col, F.col(turn_col).alias("_t"), role.alias("_role"), text.alias("_text"), F.concat(role, F.lit(": "), text).alias("_line"),
                       F.row_number().over(new).alias("_rn")).filter(F.col("_rn") <= n)
    back = Window.partitionBy(session_col).orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0)
    fits = last.withColumn("_spent", F.ceil((F.sum(F.char_length("_line") + 1).over(back) + 1) / F.lit(4.0)).cast("long")).filter(F.col("_spent") <= budget)
    g = fits.groupBy(session_col).agg(F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("at"), "_role", "_text", "_line"))).alias("_l"), F.max("_spent").alias("spent"))
    return g.select(session_col, F.transform("_l", lambda x: F.struct(x["_role"].alias("role"), x["_text"].alias("content"))).alias("turns"),
                    F.array_join(F.transform("_l", lambda x: x["_line"]), "\n").alias("turns_text"), "spent")
