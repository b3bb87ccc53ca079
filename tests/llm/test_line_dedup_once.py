"""op9_line_dedup: lines are cut into words once, and again only where a near line is possible."""

import re

from tessera.llm import linededup


def _within_one(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    if len(u) > len(v):
        u, v = v, u
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def _gone(rows):
    lines = sorted({((d is not None, d or 0), i, tuple(re.findall(r"[^\x20\x09-\x0D]+", line)))
                    for d, t in rows if t is not None for i, line in enumerate(t.split("\n"))}, key=lambda x: x[:2])
    lines = [x for x in lines if len(x[2]) >= 5]
    return sorted(((d[1] if d[0] else None, i) for j, (d, i, w) in enumerate(lines)
                   if any(w == v or _within_one(w, v) for _, _, v in lines[:j])), key=str)


def test_only_lines_with_a_shared_half_are_cut_again(spark, monkeypatch):
    rows = [(None, "zero one\ttwo three four five\nnothing near this line at all"), (1, "zero  one two\x0bthree four\r five "),
            (2, "\x0c zero one two three four six\nshort line\n\nzero one two four five"), (3, None), (4, ""), (4, ""),
            (5, "alone stands this line here now ok\nalone stands this line here now ok\nalone stands this line here now ok"),
            (6, "zero one two three four five"), (6, "zero one two three four five"), (7, "a b c d e f\r\na b c d e g f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, cut = [], linededup.cut_lineage
    monkeypatch.setattr(linededup, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    got = sorted({(r["doc_id"], r["line_no"]) for r in linededup.near_lines(docs).collect()}, key=str)
    assert got == _gone(rows)
    cutting = [p for p in plans if "posexplode" in p and "array_remove" in p]
    assert len(cutting) == 2  # all lines once, then those with a shared half
    again = cutting[1]
    # the lines are chosen by their place before any is cut into words
    assert "LeftSemi" in again and again.index("array_remove") < again.index("LeftSemi") and "array_remove" not in again[again.index("LeftSemi"):]
    assert not any(r"[\x20" in p for p in plans)  # no regular expression for each line
