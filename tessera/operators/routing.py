"""Routing and branching.

One wide table with a label column replaces N outputs; ``branches`` gives the
filtered views. Rule lists are configuration (bounded, given on the driver),
so every rule becomes part of one column expression: no join, no UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.filters import condition_node_expr, filter_expr, js_regex, valid_regex


def branches(df: DataFrame, label: str = "branch") -> dict[str, DataFrame]:
    """Filtered view per label value. Labels are collected from a distinct
    aggregate (bounded by the number of rules)."""
    vals = [r[0] for r in df.select(label).distinct().collect()]
    return {v: df.filter(F.col(label) == v) for v in vals}


def split_condition(df: DataFrame, field: str, op: str, value: Any, label: str = "branch") -> DataFrame:
    """Condition block: label each row ``"true"`` or ``"false"``."""
    c = condition_node_expr(df, field, op, value)
    return df.withColumn(label, F.when(c, F.lit("true")).otherwise(F.lit("false")))


def switch_static(df: DataFrame, output: str = "0", label: str = "output") -> DataFrame:
    """Switch in expression mode: every row to one named output."""
    return df.withColumn(label, F.lit(str(output)))


def switch_rules(df: DataFrame, rules: Sequence[dict], label: str = "output") -> DataFrame:
    """First matching rule's output, else ``default``.

    ``rules``: ``[{"output": name, "conditions": [...], "combinator": "and",
    "case_sensitive": True}]``. A rule named ``default`` shares the label with
    the fallback rows instead of replacing them.
    """
    expr: Column | None = None
    for rule in rules:
        cond = filter_expr(df, rule.get("conditions", []), rule.get("combinator", "and"),
                           rule.get("case_sensitive", True))
        expr = (F.when(cond, F.lit(rule["output"])) if expr is None
                else expr.when(cond, F.lit(rule["output"])))
    out = F.lit("default") if expr is None else expr.otherwise(F.lit("default"))
    return df.withColumn(label, out)


def _keywords(cond: Any) -> list[str]:
    if isinstance(cond, str):
        return [k.strip() for k in cond.split(",")]
    return [str(k) for k in (cond or [])]


def route_keyword(df: DataFrame, text: str, routes: Sequence[dict], default: str = "default",
                  route_col: str = "route", conf_col: str = "confidence") -> DataFrame:
    """Keyword router: share of a route's keywords found in the lowercased
    text; the strictly greatest share wins (first route on ties); a best
    share of 0 or an empty text gives ``default`` with confidence 0."""
    q = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    if not routes:
        return df.withColumn(route_col, F.lit(default)).withColumn(conf_col, F.lit(0.0))
    scored = []
    for pos, r in enumerate(routes):
        kws = _keywords(r.get("condition"))
        hits = sum((F.when(F.instr(q, F.lit(k.lower())) > 0, 1).otherwise(0) for k in kws), F.lit(0))
        score = (hits / F.lit(float(max(len(kws), 1)))).cast("double")
        scored.append(F.struct(score.alias("s"), F.lit(-pos).alias("p"), F.lit(r.get("name", "")).alias("n")))
    best = F.array_max(F.array(*scored))
    empty = q == ""
    return (df.withColumn("_best", best)
            .withColumn(route_col, F.when(empty | (F.col("_best.s") <= 0), F.lit(default))
                        .otherwise(F.col("_best.n")))
            .withColumn(conf_col, F.when(empty | (F.col("_best.s") <= 0), F.lit(0.0))
                        .otherwise(F.col("_best.s")))
            .drop("_best"))


def route_regex(df: DataFrame, text: str, routes: Sequence[dict], default: str = "default",
                route_col: str = "route", conf_col: str = "confidence") -> DataFrame:
    """Regex router: first route whose pattern matches (``i`` flag); an
    invalid pattern raises at build time, as the reference throws."""
    q = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    expr: Column | None = None
    for r in routes:
        pat = r.get("condition") or ""
        if not pat:
            continue
        if not valid_regex(pat):
            raise ValueError(f"invalid route pattern {pat!r}")
        m = F.regexp_like(q, F.lit("(?i)" + js_regex(pat)))
        expr = F.when(m, F.lit(r.get("name", ""))) if expr is None else expr.when(m, F.lit(r.get("name", "")))
    routed = F.lit(None).cast("string") if expr is None else expr
    return (df.withColumn("_r", F.when(q == "", F.lit(None)).otherwise(routed))
            .withColumn(route_col, F.coalesce(F.col("_r"), F.lit(default)))
            .withColumn(conf_col, F.when(F.col("_r").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)))
            .drop("_r"))


def policy_gate(calls: DataFrame, tool_col: str = "tool", blocked: Sequence[str] | None = None,
                allowed: Sequence[str] | None = None) -> DataFrame:
    """Tool policy: the block list first, then the allow list when one is given.
    Adds ``allowed`` (bool), ``stage`` and ``reason`` (``POLICY_VIOLATION`` text in ``error``)."""
    t = F.col(tool_col)
    is_blocked = t.isin(list(blocked)) if blocked else F.lit(False)
    not_allowed = (~t.isin(list(allowed))) if allowed is not None else F.lit(False)
    reason = (F.when(is_blocked, F.concat(F.lit("tool "), t, F.lit(" is blocked")))
              .when(not_allowed, F.concat(F.lit("tool "), t, F.lit(" is not allowed"))))
    return (calls.withColumn("reason", reason)
            .withColumn("allowed", F.col("reason").isNull())
            .withColumn("stage", F.lit("before_tool"))
            .withColumn("error", F.when(F.col("reason").isNotNull(),
                                        F.concat(F.lit("POLICY_VIOLATION:"), F.col("reason")))))


def keyword_tokens(c: Column) -> Column:
    """Lowercase, split on runs of non-alphanumerics, drop empty tokens."""
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != "")


def skill_match(queries: DataFrame, text: str, rules: Sequence[dict]) -> DataFrame:
    """Best rule per query: score = query tokens found (as substrings) in
    ``name + " " + description``, repeats counted; ties by name; none when 0.

    ``rules``: ``[{"name", "description", "allowed_tools"?}]``. Names are
    compared with a locale collation, as the reference sorts with
    ``localeCompare``.
    """
    toks = keyword_tokens(F.col(text))
    scored = []
    for r in rules:
        hay = f"{r['name']} {r.get('description', '')}".lower()
        s = F.size(F.filter(toks, lambda t: F.instr(F.lit(hay), t) > 0))
        scored.append(F.struct((-s).alias("neg"), F.collate(F.lit(r["name"]), "UNICODE").alias("k"),
                               s.alias("score"), F.lit(r["name"]).alias("name")))
    if not scored:
        return queries.withColumn("skill", F.lit(None).cast("string")).withColumn("score", F.lit(0))
    best = F.array_min(F.array(*scored))
    return (queries.withColumn("_b", best)
            .withColumn("skill", F.when(F.col("_b.score") > 0, F.col("_b.name")))
            .withColumn("score", F.col("_b.score").cast("long"))
            .drop("_b"))


def allowed_tools(df: DataFrame, rules: Sequence[dict], by: str, chosen_col: str = "skill") -> DataFrame:
    """Union of allow lists over the rules chosen per ``by`` key; null when
    none of the chosen rules restricts tools."""
    pairs = [(r["name"], list(r.get("allowed_tools") or [])) for r in rules]
    m = F.create_map(*[x for name, tools in pairs for x in (F.lit(name), F.array(*[F.lit(t) for t in tools]).cast("array<string>"))]) \
        if pairs else F.create_map().cast("map<string,array<string>>")
    # distinct choices first: a key with many rows brings each rule once
    chosen = df.select(by, chosen_col).distinct()
    lists = chosen.select(by, F.explode_outer(F.try_element_at(m, F.col(chosen_col))).alias("_t"))
    g = lists.groupBy(by).agg(F.array_sort(F.collect_set("_t")).alias("_u"))
    return g.withColumn("allowed_tools", F.when(F.size("_u") > 0, F.col("_u"))).drop("_u")
