"""Number texts: every value a text can take, and none ends a job."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import jsvalues as J
from tessera.operators import aggregates as A
from tessera.operators import filters as FL

#: text -> number (None: not a number)
NUMBERS = {
    "": 0.0, "  ": 0.0, "\t\n": 0.0, " ﻿": 0.0, "5": 5.0, " 5\n": 5.0, "+5": 5.0, "-5.": -5.0, ".5": 0.5, "1e3": 1000.0, "1E-2": 0.01, "1e400": math.inf,
    ".": None, "e5": None, "5px": None, "1_000": None, "1,5": None, "--5": None, "5 5": None, "NaN": None, "nan": None, "Infinity": math.inf, "+Infinity": math.inf,
    "-Infinity": -math.inf, "infinity": None, "inf": None, "1d": None, "1f": None, "0x": None, "0x10": 16.0, "0XfF": 255.0, "-0x10": None, "+0x10": None, "0x1.8": None,
    "0xfg": None, "0b11": 3.0, "0b12": None, "0b": None, "0o17": 15.0, "0o9": None, "0O7": 7.0, "017": 17.0, "0x0000000000000000000000001": 1.0, "0x0": 0.0,
    "0xfffffffffffffffff": float(int("f" * 17, 16)), "0x" + "f" * 64: float(int("f" * 64, 16)), "0x" + "f" * 300: math.inf, "0b" + "1" * 70: float(int("1" * 70, 2)),
    "0x20000000000001": float(0x20000000000001), "0x20000000000003": float(0x20000000000003), "0x400000000000020000000001": float(0x400000000000020000000001),
    "0x80000000000004000": float(0x80000000000004000), "0x80000000000004001": float(0x80000000000004001), "true": None, "null": None, "١": None,
    "9" * 400: math.inf, "0" * 400 + "7": 7.0,
}


def test_number_texts(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", J.js_number(F.col("t"), T.StringType()).alias("n")).collect()}
    assert got == NUMBERS
    literals = {t: J.js_number_literal(t) for t in NUMBERS}
    assert {t: None if math.isnan(v) else v for t, v in literals.items()} == NUMBERS


def test_long_digits_round_to_the_nearest_double(spark):
    r = random.Random(8)
    texts = [f"0{p}" + "".join(r.choices(d, k=r.randint(1, 90))) for p, d in (("x", "0123456789abcdef"), ("o", "01234567"), ("b", "01")) for _ in range(200)]
    texts += ["0x8" + "0" * 12 + "4" + "0" * 20 + x for x in "01"]
    got = {x["t"]: x["n"] for x in spark.createDataFrame([(t,) for t in texts], "t string").select("t", J.js_number(F.col("t"), T.StringType()).alias("n")).collect()}
    assert got == {t: float(int(t, 0)) for t in texts}


@pytest.mark.parametrize("op", ["gt", "gte", "lt", "lte"])
def test_comparisons_survive_any_text(spark, op):
    df = spark.createDataFrame([("0xfffffffffffffffff",), ("5",), ("0b12",), ("1",), ("zz",)], "v string")
    got = {r["v"] for r in FL.filter_rows(df, [("v", op, 3)]).collect()}
    assert got == ({"0xfffffffffffffffff", "5"} if op[0] == "g" else {"1"})


def test_summaries_and_casts_survive_any_text(spark):
    df = spark.createDataFrame([("0xfffffffffffffffff",), ("5",), ("0o9",), (" ",)], "v string")
    out = A.summarize(df, None, [(f, "v") for f in ("count", "sum", "avg", "min", "max")]).collect()[0].asDict()
    huge = float(0xfffffffffffffffff)
    assert out == {"count_v": 4, "sum_v": huge + 5.0, "avg_v": (huge + 5.0) / 3, "min_v": 0.0, "max_v": huge}


# --- pages, patterns, citations ----------------------------------------------

@pytest.mark.parametrize("page, title, text", [
    ("<html><head><title>T</title><body><p>Hello</p></body></html>", "T", "Hello"),  # no </head>
    ("<head><title>T</title>Hello", "T", "Hello"),  # text ends a head
    ("<body><nav><a>Home</a><main><p>Hello</p></main></body>", "", "Hello"),  # unclosed nav before the content
    ("<body><div><nav><a>Home</a></div><p>Hello</p>", "", "Hello"),  # ended by its parent
    ("<nav><a>Home</a> <p>Hello</p>", "", "Home\nHello"),  # never closed, and nothing else: taken back
    ("<nav>a<nav>b</nav>c</nav>d", "", "d"), ("</nav></div>x</p>y", "", "x\ny"), ("a<br>b<br/>c<hr>d", "", "a\nb\ncd"),
    ("<p>a<script>b</script>c<style>d</style><noscript>e</noscript></p>f", "", "ac\nf"), ("", "", ""), (None, "", ""),
    ("<title>A &amp; B</title><p>x &lt; y</p><!-- no -->", "A & B", "x < y"), ("<template><p>x</p></template>y", "", "y"),
])
def test_pages(page, title, text):
    from tessera.operators.text import html_to_text

    assert html_to_text(page) == (title, text)


@pytest.mark.parametrize("pattern, text, typ, value", [
    (r"(?<year>\d{4})", "in 2024", "int", 2024), (r"\d{4}", "in 2024", "int", 2024), (r"(\d+)?px", "px 3px", "str", "px"), (r"(\d*)px", "px 3px", "str", ""),
    (r"(\d+)?px", "12px", "str", "12"), (r"a|b(c)", "xa", "str", "a"), (r"b(c)|a", "xbc", "str", "c"), (r"(?<a>x)(?<b>y)\k<a>", "xyx", "str", "x"),
    (r"(\d+)", "none", "int", None), (r"v=(\S+)", "v=1.5e1 z", "float", 15.0), (r"ok: (\w+)", "ok: Yes", "bool", True), (r"(?:a)(b)$", "ab\n", "str", None), (r"é+", "caféé", "str", "éé"),
])
def test_fields(spark, pattern, text, typ, value):
    from tessera.operators.text import extract_fields

    df = spark.createDataFrame([(text,)], "t string")
    assert extract_fields(df, "t", [{"name": "f", "pattern": pattern, "type": typ}]).first()["f"] == value


@pytest.mark.parametrize("pattern", ["(", "[a", "(?<n>a)(?<n>b)", "a{2,1}", "[^]"])
def test_bad_patterns_raise(spark, pattern):
    from tessera.operators.text import extract_fields

    with pytest.raises(ValueError):
        extract_fields(spark.createDataFrame([("a",)], "t string"), "t", [{"name": "f", "pattern": pattern}])


def test_citations_of_every_length(spark, monkeypatch):
    from tessera.operators import text as TX

    monkeypatch.setattr(TX, "AUTOMATON_QUOTES", 7)
    r = random.Random(9)
    words = ["ab", "b", "éa", "c", "abc", "d."]
    docs = [(i if i % 9 else None, " ".join(r.choices(words, k=r.randint(0, 12)))) for i in range(60)] + [(100, None), (101, ""), (102, "x" * 200_000 + " ab b")]
    cites = [(i, " ".join(r.choices(words, k=r.randint(1, 7)))) for i in range(40)] + [(50, "b"), (51, "b"), (52, ""), (53, None), (54, " "), (55, "a b"), (56, "zz"), (57, "x" * 1000)]
    c, d = spark.createDataFrame(cites, "cite_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    want = {(i, j) for i, q in cites for j, t in docs if q is not None and t is not None and q in t}
    found = TX.citation_matches(c, d)
    # a document without an id is no match by itself in the joins of longer quotes
    assert {tuple(x) for x in found.collect() if x[1] is not None} == {x for x in want if x[1] is not None}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = {x["cite_id"]: x["found"] for x in TX.verify_citations(c, d.where("doc_id IS NOT NULL")).collect()}
    assert got == {i: any(x == i and j is not None for x, j in want) for i, _ in cites}
