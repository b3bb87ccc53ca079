"""Golden cases of the item operators (inputs and expected outputs of the
reference's unit tests, as listed in FIXTURES.md part 1)."""

from pyspark.sql import functions as F

from tessera.functions import scalars as C
from tessera.operators import aggregates as A
from tessera.operators import filters as FL
from tessera.operators import ordering as O
from tessera.operators import routing as R
from tessera.operators import shaping as P
from tessera.operators import text as TX
from tests.conftest import rows


def test_set_manual(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    out = P.set_fields(df, [("status", "string", "active"), ("count", "number", "42")])
    assert sorted(rows(out, "id", "status", "count")) == [(1, "active", 42.0), (2, "active", 42.0)]


def test_set_json_and_bad_json(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert rows(P.set_json(df, '{"flag": true}'), "id", "flag") == [(1, True)]
    assert P.set_json(df, "{bad").columns == ["id"]


def test_filter_equals(spark):
    df = spark.createDataFrame([("active",), ("inactive",), ("active",)], "status string")
    out = FL.filter_rows(df, [("={{$json.status}}", "equals", "active")])
    assert rows(out) == [("active",), ("active",)]


def test_filter_or(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    out = FL.filter_rows(df, [("n", "equals", 1), ("n", "equals", 3)], combinator="or")
    assert sorted(rows(out)) == [(1,), (3,)]


def test_filter_strict_types_and_numbers(spark):
    df = spark.createDataFrame([("1", 1), (" 2 ", 2), ("x", 3), ("", 0)], "s string, n int")
    # "1" !== 1
    assert rows(FL.filter_rows(df, [("s", "equals", 1)])) == []
    # Number(" 2 ") = 2, Number("x") is NaN (false), Number("") = 0
    assert sorted(r[1] for r in rows(FL.filter_rows(df, [("s", "gte", 1)]))) == [1, 2]
    assert [r[1] for r in rows(FL.filter_rows(df, [("s", "lt", 1)]))] == [0]
    # notContains on a non-string is false
    assert rows(FL.filter_rows(df, [("n", "notContains", "9")])) == []
    # bad regex matches nothing
    assert rows(FL.filter_rows(df, [("s", "regex", "(")])) == []
    # no conditions keep everything
    assert len(rows(FL.filter_rows(df, []))) == 4


def test_switch_rules(spark):
    df = spark.createDataFrame([(5,), (20,), (30,)], "n int")
    out = R.switch_rules(df, [{"output": "high", "conditions": [("n", "gt", 10)]}])
    assert sorted(rows(out, "n", "output")) == [(5, "default"), (20, "high"), (30, "high")]


def test_aggregate_rows_and_field(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    f = A.collect_field(df, "id", ["id"])
    assert rows(f, "id") == [([1, 2, 3],)]
    r = A.collect_rows(df.filter("id < 3"), ["id"])
    assert [[x["id"] for x in rows(r, "data")[0][0]]] == [[1, 2]]


def test_aggregate_pages_are_bounded(spark):
    df = spark.range(25).withColumn("g", F.lit(1))
    f = A.collect_field(df, "id", ["id"], by=["g"], page_size=10)
    got = sorted(rows(f, "page", "id"))
    assert [len(x[1]) for x in got] == [10, 10, 5]
    assert sum((x[1] for x in got), []) == list(range(25))


def test_sort_and_limit(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "n int")
    assert rows(O.sort_rows(df, "n")) == [(1,), (2,), (3,)]
    assert rows(O.sort_rows(df, "n", "descending")) == [(3,), (2,), (1,)]
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows(O.limit_rows(ids, 2, ["id"])) == [(1,), (2,)]
    assert rows(O.limit_rows(ids, 2, ["id"], keep="last")) == [(2,), (3,)]


def test_sort_locale(spark):
    df = spark.createDataFrame([("c",), ("B",), ("a",)], "s string")
    assert [r[0] for r in rows(O.sort_rows(df, "s"))] == ["a", "B", "c"]


def test_split_out(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["x"]), (3, [])], "id int, tags array<string>")
    assert len(rows(O.split_out(df, "tags"))) == 4


def test_summarize(spark):
    df = spark.createDataFrame([("a", 10), ("a", 20), ("b", None)], "team string, score int")
    out = A.summarize(df, "team", [("count", ""), ("sum", "score"), ("avg", "score"), ("min", "score")])
    got = {r[0]: r[1:] for r in rows(out, "team", "count_items", "sum_score", "avg_score", "min_score")}
    assert got == {"a": (2, 30.0, 15.0, 10.0), "b": (1, 0.0, 0.0, None)}


def test_summarize_null_key_joins_empty_group(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("x", 3)], "k string, v int")
    out = A.summarize(df, "k", [("count", "")])
    assert sorted(rows(out)) == [("", 2), ("x", 1)]


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,), (1,)], "id int")
    assert sorted(rows(O.remove_duplicates(df))) == [(1,), (2,)]
    e = spark.createDataFrame([(1, "a@x"), (2, "a@x"), (3, "b@x")], "id int, email string")
    out = O.remove_duplicates(e, ["email"], order_by=["id"])
    assert sorted(rows(out)) == [(1, "a@x"), (3, "b@x")]


def test_datetime(spark):
    df = spark.createDataFrame([("2026-01-01T00:00:00Z", "2026-01-01T00:01:00Z")], "s string, e string")
    d = df.select(C.dt_diff(C.dt_parse(F.col("s")), C.dt_parse(F.col("e"))).alias("d"))
    assert rows(d) == [(60.0,)]
    f = df.select(C.dt_format(C.dt_shift(C.dt_parse(F.col("s")), 2, "hours"), "yyyy/MM/dd HH:mm T").alias("f"))
    assert rows(f) == [("2026/01/01 02:00 T",)]


CONDITION_CASES = [
    ("eq", 5, 5, True), ("eq", 5, "5", False), ("neq", 5, 6, True), ("gt", 10, 5, True), ("gt", 5, 10, False),
    ("lt", 3, 5, True), ("gte", 5, 5, True), ("lte", 4, 5, True), ("contains", "hello world", "world", True),
    ("contains", "hello", "xyz", False), ("empty", "", None, True), ("empty", "x", None, False),
    ("not_empty", "x", None, True), ("not_empty", 0, None, False),
]


def test_condition_table(spark):
    for op, actual, expected, want in CONDITION_CASES:
        dtype = "string" if isinstance(actual, str) else "int"
        df = spark.createDataFrame([(actual,)], f"val {dtype}")
        got = rows(FL.where_condition(df, "val", op, expected))
        assert (len(got) == 1) == want, (op, actual, expected)


def test_template(spark):
    df = spark.createDataFrame([("World",)], "name string")
    assert rows(P.render_template(df, "Hello {{name}}!"), "prompt") == [("Hello World!",)]
    lst = spark.createDataFrame([(["apple", "banana"],)], "items array<string>")
    assert rows(P.render_template(lst, "{{items}}"), "prompt") == [("- apple\n- banana",)]


def test_loop(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "items array<string>")
    out = O.iterate(df, "items", 100)
    assert sorted(rows(out, "index", "item", "total", "is_last")) == [(0, "a", 3, False), (1, "b", 3, False), (2, "c", 3, True)]
    flagged = O.iterate(df, "items", 2, on_limit="flag")
    assert rows(flagged, "error") == [] or all(r[0] for r in rows(flagged, "error"))


def test_routers(spark):
    df = spark.createDataFrame([("help with code",), ("send to user@test.com",)], "query string")
    kw = R.route_keyword(df, "query", [{"name": "tech", "condition": "code, bug"}, {"name": "sales", "condition": "price"}])
    assert rows(kw, "route")[0] == ("tech",)
    rx = R.route_regex(df, "query", [{"name": "email", "condition": r"[\w.]+@[\w.]+"}])
    assert [r[0] for r in rows(rx, "route")] == ["default", "email"]


def test_answer(spark):
    df = spark.createDataFrame([("a long answer text",)], "text string")
    out = P.format_answer(df, "text", max_length=6)
    assert rows(out, "answer") == [("a long...",)]


def test_select_paths(spark):
    df = spark.createDataFrame([("Ann", 30, "x")], "name string, age int, extra string")
    assert P.select_paths(df, ["name", "age"]).columns == ["name", "age"]


def test_rerank(spark):
    df = spark.createDataFrame([("a", 0.3), ("b", 0.9), ("c", 0.6)], "id string, score double")
    assert [r[0] for r in rows(O.rerank(df, 2), "id")] == ["b", "c"]


def test_extract(spark):
    df = spark.createDataFrame([("Published in 2024",)], "text string")
    out = TX.extract_fields(df, "text", [{"name": "year", "pattern": r"(\d{4})", "type": "int"}])
    assert rows(out, "year") == [(2024,)]


def test_slugify_repeats(spark):
    df = spark.createDataFrame([(1, "Set"), (2, "Set")], "n int, name string")
    out = C.slugify(df, "name", ["n"])
    assert sorted(rows(out, "slug")) == [("set",), ("set_1",)]
