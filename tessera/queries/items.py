"""Item operators on the TPC-H-like tables: filters, conditions, summarize,
sort, limit, distinct, split-out, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import filters as FL
from tessera.operators import ordering as O
from tessera.queries import query
from tessera.session import Tables

LI = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"]
LI_SQL = "l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus"


def _li(spark, d):
    return Tables(spark, d).lineitem


# ---------------------------------------------------------------- filters


@query("filter_equals", f"SELECT {LI_SQL} FROM lineitem WHERE l_returnflag = 'R'")
def filter_equals(spark, d):
    return FL.filter_rows(_li(spark, d), [("l_returnflag", "equals", "R")]).select(*LI)


@query("filter_not_equals", f"SELECT {LI_SQL} FROM lineitem WHERE l_linestatus IS DISTINCT FROM 'O'")
def filter_not_equals(spark, d):
    return FL.filter_rows(_li(spark, d), [("l_linestatus", "notEquals", "O")]).select(*LI)


@query("filter_gt", f"SELECT {LI_SQL} FROM lineitem WHERE l_quantity > 30")
def filter_gt(spark, d):
    # the right side is text, as it arrives from a form: Number("30")
    return FL.filter_rows(_li(spark, d), [("={{$json.l_quantity}}", "gt", "30")]).select(*LI)


@query("filter_gte", f"SELECT {LI_SQL} FROM lineitem WHERE l_quantity >= 30")
def filter_gte(spark, d):
    return FL.filter_rows(_li(spark, d), [("l_quantity", "gte", 30)]).select(*LI)


@query("filter_lt", f"SELECT {LI_SQL} FROM lineitem WHERE l_quantity < 10")
def filter_lt(spark, d):
    return FL.filter_rows(_li(spark, d), [("l_quantity", "lt", 10)]).select(*LI)


@query("filter_lte", f"SELECT {LI_SQL} FROM lineitem WHERE l_quantity <= 10")
def filter_lte(spark, d):
    return FL.filter_rows(_li(spark, d), [("l_quantity", "lte", " 10 ")]).select(*LI)


PA = ["p_partkey", "p_name", "p_type"]
PA_SQL = "p_partkey, p_name, p_type"


@query("filter_contains", f"SELECT {PA_SQL} FROM part WHERE contains(p_name, 'ring')")
def filter_contains(spark, d):
    return FL.filter_rows(Tables(spark, d).part, [("p_name", "contains", "ring")]).select(*PA)


@query("filter_not_contains", f"SELECT {PA_SQL} FROM part WHERE NOT contains(p_name, 'ring')")
def filter_not_contains(spark, d):
    return FL.filter_rows(Tables(spark, d).part, [("p_name", "notContains", "ring")]).select(*PA)


@query("filter_starts_with", f"SELECT {PA_SQL} FROM part WHERE starts_with(p_name, 'small')")
def filter_starts_with(spark, d):
    return FL.filter_rows(Tables(spark, d).part, [("p_name", "startsWith", "small")]).select(*PA)


@query("filter_ends_with", f"SELECT {PA_SQL} FROM part WHERE suffix(p_name, 'gear')")
def filter_ends_with(spark, d):
    return FL.filter_rows(Tables(spark, d).part, [("p_name", "endsWith", "gear")]).select(*PA)


@query("filter_regex", f"SELECT {PA_SQL} FROM part WHERE regexp_matches(p_name, '^(red|blue) (bolt|gear)$')")
def filter_regex(spark, d):
    return FL.filter_rows(Tables(spark, d).part,
                          [("p_name", "regex", "^(red|blue) (bolt|gear)$")]).select(*PA)


# stand-in input with missing values: a discount of 0 is recorded as missing
_DISC = "l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS disc"


@query("filter_exists", f"SELECT * FROM (SELECT {_DISC} FROM lineitem) WHERE disc IS NOT NULL")
def filter_exists(spark, d):
    src = _li(spark, d).select("l_orderkey", "l_linenumber",
                               F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"))
    return FL.filter_rows(src, [("disc", "exists", None)])


@query("filter_is_empty", """
SELECT * FROM (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END AS flag
  FROM lineitem) WHERE flag IS NULL OR flag = ''
""")
def filter_is_empty(spark, d):
    li = _li(spark, d)
    src = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", None)
                    .when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_returnflag")).alias("flag"))
    return FL.filter_rows(src, [("flag", "isEmpty", None)])


@query("filter_and_or", f"""
SELECT {LI_SQL} FROM lineitem
WHERE (l_quantity > 45 AND lower(l_returnflag) = 'a') OR starts_with(lower(l_linestatus), 'x')
""")
def filter_and_or(spark, d):
    li = _li(spark, d)
    both = FL.filter_expr(li, [("l_quantity", "gt", 45), ("l_returnflag", "equals", "a")],
                          "and", case_sensitive=False)
    either = FL.filter_expr(li, [("l_linestatus", "startsWith", "X")], "or", case_sensitive=False)
    return li.filter(both | either).select(*LI)


@query("filter_unknown_op", f"SELECT {LI_SQL} FROM lineitem WHERE l_returnflag = 'A'")
def filter_unknown_op(spark, d):
    # an unknown operation name falls back to strict equality
    return FL.filter_rows(_li(spark, d), [("l_returnflag", "sameAs", "A")]).select(*LI)


# ------------------------------------------------------- condition node
OR = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
OR_SQL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query("cond_eq", f"SELECT {OR_SQL} FROM orders WHERE o_orderstatus = 'F'")
def cond_eq(spark, d):
    return FL.where_condition(Tables(spark, d).orders, "o_orderstatus", "eq", "F").select(*OR)


@query("cond_neq", f"SELECT {OR_SQL} FROM orders WHERE o_orderstatus <> 'F'")
def cond_neq(spark, d):
    return FL.where_condition(Tables(spark, d).orders, "o_orderstatus", "neq", "F").select(*OR)


@query("cond_compare", f"SELECT {OR_SQL} FROM orders WHERE o_totalprice >= 200000")
def cond_compare(spark, d):
    return FL.where_condition(Tables(spark, d).orders, "o_totalprice", "gte", "200000").select(*OR)


@query("cond_contains", f"SELECT {OR_SQL} FROM orders WHERE contains(CAST(o_custkey AS VARCHAR), '77')")
def cond_contains(spark, d):
    # String(number).includes(...)
    return FL.where_condition(Tables(spark, d).orders, "o_custkey", "contains", 77).select(*OR)


@query("cond_empty", """
SELECT o_orderkey, pr FROM (SELECT o_orderkey,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS pr FROM orders)
WHERE pr IS NULL OR pr = ''
""")
def cond_empty(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.when(
        F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("pr"))
    return FL.where_condition(o, "pr", "empty", None)


@query("cond_not_empty", """
SELECT l_orderkey, l_linenumber, disc FROM (SELECT l_orderkey, l_linenumber, l_discount AS disc
  FROM lineitem) WHERE disc IS NOT NULL AND disc <> 0
""")
def cond_not_empty(spark, d):
    li = _li(spark, d).select("l_orderkey", "l_linenumber", F.col("l_discount").alias("disc"))
    return FL.where_condition(li, "disc", "not_empty", None)


@query("cond_unknown", f"SELECT {OR_SQL} FROM orders WHERE false")
def cond_unknown(spark, d):
    return FL.where_condition(Tables(spark, d).orders, "o_orderstatus", "like", "F").select(*OR)


# ------------------------------------------------------------ summarize


@query("summarize_count", """
SELECT l_returnflag, count(*) AS count_items, count(l_quantity) AS count_l_quantity
FROM lineitem GROUP BY l_returnflag
""")
def summarize_count(spark, d):
    return A.summarize(_li(spark, d), "l_returnflag", [("count", ""), ("count", "l_quantity")])


@query("summarize_sum", """
SELECT l_linestatus, round(sum(l_quantity), 2) AS sum_l_quantity,
       round(sum(l_extendedprice), 2) AS sum_l_extendedprice
FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R' GROUP BY l_linestatus
""")
def summarize_sum(spark, d):
    li = FL.filter_rows(_li(spark, d), [("l_quantity", "gt", 30), ("l_returnflag", "equals", "R")])
    s = A.summarize(li, "l_linestatus", [("sum", "l_quantity"), ("sum", "l_extendedprice")])
    return s.select("l_linestatus", F.round("sum_l_quantity", 2).alias("sum_l_quantity"),
                    F.round("sum_l_extendedprice", 2).alias("sum_l_extendedprice"))


@query("summarize_avg", """
SELECT CAST(l_linenumber AS VARCHAR) AS l_linenumber, round(avg(l_discount), 6) AS avg_l_discount,
       round(avg(l_tax), 6) AS avg_l_tax
FROM lineitem GROUP BY l_linenumber
""")
def summarize_avg(spark, d):
    s = A.summarize(_li(spark, d), "l_linenumber", [("avg", "l_discount"), ("avg", "l_tax")])
    return s.select("l_linenumber", F.round("avg_l_discount", 6).alias("avg_l_discount"),
                    F.round("avg_l_tax", 6).alias("avg_l_tax"))


@query("summarize_min", """
SELECT l_returnflag, min(l_extendedprice) AS min_l_extendedprice, min(l_quantity) AS min_l_quantity
FROM lineitem GROUP BY l_returnflag
""")
def summarize_min(spark, d):
    return A.summarize(_li(spark, d), "l_returnflag",
                       [("min", "l_extendedprice"), ("min", "l_quantity")])


@query("summarize_max", """
SELECT l_returnflag, max(l_extendedprice) AS max_l_extendedprice, max(l_quantity) AS max_l_quantity
FROM lineitem GROUP BY l_returnflag
""")
def summarize_max(spark, d):
    return A.summarize(_li(spark, d), "l_returnflag",
                       [("max", "l_extendedprice"), ("max", "l_quantity")])


@query("summarize_global", """
SELECT count(*) AS count_items, round(coalesce(sum(l_quantity), 0), 2) AS sum_l_quantity,
       min(l_quantity) AS min_l_quantity, round(coalesce(avg(l_quantity), 0), 6) AS avg_l_quantity
FROM lineitem WHERE l_quantity > 1000
""")
def summarize_global(spark, d):
    # no group and no matching row: still one row, sum and avg 0, min null
    li = FL.filter_rows(_li(spark, d), [("l_quantity", "gt", 1000)])
    s = A.summarize(li, None, [("count", ""), ("sum", "l_quantity"), ("min", "l_quantity"),
                               ("avg", "l_quantity")])
    return s.select("count_items", F.round("sum_l_quantity", 2).alias("sum_l_quantity"),
                    "min_l_quantity", F.round("avg_l_quantity", 6).alias("avg_l_quantity"))


# ------------------------------------------------------ sort / limit / distinct


@query("sort_asc", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_asc(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return O.sort_rows(o, "o_totalprice", "ascending", tiebreak=["o_orderkey"])


@query("sort_desc", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_name DESC, c_custkey")
def sort_desc(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_acctbal")
    return O.sort_rows(c, "c_name", "descending", tiebreak=["c_custkey"])


@query("sort_random", "SELECT o_orderkey, o_custkey FROM orders")
def sort_random(spark, d):
    return O.sort_rows(Tables(spark, d).orders.select("o_orderkey", "o_custkey"), None, "random", seed=7)


@query("limit_first", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def limit_first(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return O.limit_rows(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("limit_last", """
SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10) ORDER BY o_totalprice, o_orderkey
""")
def limit_last(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return O.limit_rows(o, 10, ["o_totalprice", "o_orderkey"], keep="last")


@query("rerank_topk", """
SELECT o_custkey, o_orderkey, o_totalprice AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 2
""")
def rerank_topk(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("score"))
    return O.rerank(o, 2, by=["o_custkey"], tiebreak="o_orderkey")


@query("top_k_per_group", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 3
""")
def top_k_per_group(spark, d):
    li = _li(spark, d).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    li = li.withColumn("_tb", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return O.top_k(li, ["l_suppkey"], "l_extendedprice", 3, tiebreak="_tb").drop("_tb")


@query("distinct_all", """
SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem
""")
def distinct_all(spark, d):
    return O.remove_duplicates(_li(spark, d).select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("distinct_fields", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_partkey
    ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1
""")
def distinct_fields(spark, d):
    li = _li(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                              "l_returnflag", "l_linestatus")
    out = O.remove_duplicates(li, ["l_returnflag", "l_linestatus", "l_partkey"],
                              order_by=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("split_out", """
SELECT p_partkey, w AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)
""")
def split_out(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.split("p_name", " ").alias("word"))
    return O.split_out(p, "word")


@query("aggregate_field", """
SELECT o_custkey, CAST(floor(pos / 10000) AS BIGINT) AS page,
       string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY pos) AS o_orderkey
FROM (SELECT o_custkey, o_orderkey,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
GROUP BY o_custkey, page
""")
def aggregate_field(spark, d):
    o = Tables(spark, d).orders
    out = A.collect_field(o, "o_orderkey", ["o_orderdate", "o_orderkey"], by=["o_custkey"])
    return out.select("o_custkey", "page", F.array_join(
        F.transform("o_orderkey", lambda x: x.cast("string")), ",").alias("o_orderkey"))


@query("aggregate_rows", """
SELECT n_regionkey, CAST(floor(pos / 10000) AS BIGINT) AS page,
       string_agg(n_name || ':' || CAST(n_nationkey AS VARCHAR), ',' ORDER BY pos) AS data
FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos FROM nation)
GROUP BY n_regionkey, page
""")
def aggregate_rows(spark, d):
    n = Tables(spark, d).nation
    out = A.collect_rows(n, ["n_nationkey"], by=["n_regionkey"])
    return out.select("n_regionkey", "page", F.array_join(F.transform(
        "data", lambda r: F.concat(r["n_name"], F.lit(":"), r["n_nationkey"].cast("string"))), ",").alias("data"))
