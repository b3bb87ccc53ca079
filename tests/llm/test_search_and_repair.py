"""Ranked search, exact top-k and conversation repair against brute force, on
small tables with nulls, ties, repeated rows, long rows and clashing names."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import convrepair, lexical, topk

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


# --- op11 --------------------------------------------------------------------

def terms(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        scores = []
        for d, c, n in held:
            m = 10 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if none else d, -s))
    return out


def words_corpus(seed=3, n=900):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "ñu", "x_y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(r.choices(vocabulary, weights, k=r.choice([0, 1, 3, 30, 80])))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(None, "w3 W3 w5"), (None, None), (5, "w3 w300"), (5, "w3 w300"), (n + 50, None), (n + 51, ""), (n + 52, " ?!_ "), (n + 53, "w1 " * 50_000 + "w399")]
    r.shuffle(docs)
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 4, 20])))) for i in range(30)]
    return docs, items + [(2, "w9 w9"), (None, "w3"), (90, ""), (91, None), (92, "unheard"), (93, "?!")]


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search_equals_brute_force(spark, monkeypatch, small):
    if small:  # several shards, blocks and windows, and query blocks of a few rows
        for name, value in (("SHARD_DOCS", 150), ("FIRST_WINDOW", 8), ("WINDOW", 32), ("BLOCK", 4), ("QUERY_ROWS", 12), ("PIECE", 1000)):
            monkeypatch.setattr(lexical, name, value)
    docs, items = words_corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("term", F.lit(1)).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(None).cast("string"))
    got = [tuple(r) for r in lexical.rank_documents(d, q).collect()]
    assert sorted(got, key=str) == sorted(ranked(docs, items), key=str)


def test_ranked_search_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank_documents(d, q).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.rank_documents(d, q).count() == 0
    assert lexical.rank_documents(d.unionByName(spark.createDataFrame([(1, "?")], d.schema)), q).count() == 0
    assert lexical.rank_documents(spark.createDataFrame([(1, "a")], d.schema), q.limit(0)).count() == 0


def shard_of(n, lists, k=3):
    """Shard over documents of 10 terms each; lists: term -> {doc: tf}."""
    figures = lexical.Figures(n, 10 * n, {t: len(p) for t, p in lists.items()})
    pack = lambda p: lexical.Postings(*lexical.Postings.pack(*(np.array(x, dtype=np.int64) for x in (sorted(p), [p[d] for d in sorted(p)], [10] * len(p)))))
    return lexical.Shard(np.full(n, 10, dtype=np.int64), {t: pack(p) for t, p in lists.items()}, figures), figures


def test_blocks_are_left_packed():
    """A rare term's heap makes the common term non-essential: only blocks that hold a candidate are unpacked."""
    n = 20_000
    common, rare = {d: 1 for d in range(n)}, {d: 3 for d in (1, 2, 3, 40, 9000, 9001, 15_000)}
    del common[17]
    shard, figures = shard_of(n, {0: common, 1: rare})
    docs, scores = shard.search([0, 1], 3, 64)
    assert docs.tolist() == [1, 2, 3] and len(set(scores.tolist())) == 1
    opened = [b for t, b in shard.opened if t == 0]
    assert len(opened) < 5 < len(shard.postings[0].last)
    whole = figures.weight[0] * lexical.Figures.impact(np.array([1]), figures.damping(np.array([10])))[0] + figures.weight[1] * lexical.Figures.impact(np.array([3]), figures.damping(np.array([10])))[0]
    assert scores[0] == whole


def test_block_maximum_is_exact():
    r = random.Random(5)
    for _ in range(50):
        n = r.randint(1, 300)
        docs = np.array(sorted(r.sample(range(10_000), n)), dtype=np.int64)
        tf, length = np.array([r.randint(1, 9) for _ in docs]), np.array([r.randint(1, 2000) for _ in docs])
        p = lexical.Postings(*lexical.Postings.pack(docs, tf, length))
        figures = lexical.Figures(1000, 300_000, {})
        by_frontier = np.maximum.reduceat(lexical.Figures.impact(p.tf, figures.damping(p.length)), p.frontier)
        every = lexical.Figures.impact(tf, figures.damping(length))
        assert by_frontier.tolist() == [int(every[a:a + lexical.BLOCK].max()) for a in range(0, n, lexical.BLOCK)]
        assert np.concatenate([p.block(i)[0] for i in range(len(p.last))]).tolist() == docs.tolist()
        assert np.concatenate([p.block(i)[1] for i in range(len(p.last))]).tolist() == tf.tolist()


# --- op12 --------------------------------------------------------------------

def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def nearest(rows, k=10):
    q = {}
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if usable(v)]
    for i, v in whole:
        if i is not None and i % 100 == 0:
            q[i] = min(v, q.get(i, v))
    out = []
    for i, v in q.items():
        scores = sorted((-max(-(1 << 61), min(1 << 61, sum(a * b for a, b in zip(v, w)))), j is None, j or 0) for j, w in whole if j != i and len(w) == len(v))
        out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scores[:k], 1)]
    return out


def vectors(seed=4):
    r = random.Random(seed)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)] + [(1100, [0.5] * 6)]  # ties
    rows += [(None, [0.9] * 6), (None, None), (1200, None), (1201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1202, [math.nan] * 6), (1300, [math.inf] * 6), (3, rows[3][1]),
             (1400, []), (1401, []), (1500, [0.25]), (1501, [-3.0]), (1600, [0.0] * 6), (1700, [1e18] * 6), (1701, [-1e18] * 6)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_exact_topk_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("BINS", 3), ("QUERY_ROWS", 3), ("SCORE_CELLS", 64)):
            monkeypatch.setattr(topk, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).repartition(3)
    got = [tuple(r) for r in topk.exact_topk(df, df.where("vec_id % 100 = 0")).collect()]
    assert sorted(got, key=str) == sorted(nearest(rows), key=str)


def test_topk_of_nothing(spark):
    df = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert topk.exact_topk(df, df).count() == 0
    assert topk.exact_topk(df.limit(0), df).count() == 0
    assert topk.exact_topk(df, df.limit(0)).columns == ["query_id", "rank", "vec_id", "score"]


# --- op13 --------------------------------------------------------------------

SOUND_ROLES = re.compile(r"(s?(ua)+)?")


def cheapest(items):
    """Least (cost, audit, repaired initials with their rows) of all edit sequences, by whole enumeration up to two inserts a place."""
    best = None
    options = []
    for kind, initial in items:
        more = 5 if kind == "T" else 0
        o = [(2, "D", "")]
        if kind != "D":
            o += [(more, "K", initial)] + [(1 + more, "R", x) for x in "ua"]
        options.append(o)
    gaps = [(0, "", ""), (5, "I", "u"), (5, "I", "a"), (10, "II", "ua"), (10, "II", "au")]
    for choice in itertools.product(gaps, *itertools.chain.from_iterable(zip(options, itertools.repeat(gaps)))):
        roles = "".join(c[2] for c in choice)
        if SOUND_ROLES.fullmatch(roles):
            new = (sum(c[0] for c in choice), "".join(c[1] for c in choice))
            best = new if best is None else min(best, new)
    return best


def automaton(items):
    """Least (cost, audit) by whole tables over rows and states, for long conversations."""
    moves = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    speaker = "uuau"

    def inserted(t):
        for _ in range(3):
            for q, (c, a) in list(t.items()):
                x, new = moves[q][speaker[q]], (c + 5, a + "I")
                t[x] = min(t.get(x, new), new)
        return t

    t = inserted({0: (0, "")})
    for kind, initial in items:
        new, more = {}, 5 if kind == "T" else 0
        for q, (c, a) in t.items():
            steps = [(q, c + 2, a + "D")]
            if kind != "D":
                steps.append((moves[q][speaker[q]], c + 1 + more, a + "R"))
                if initial in moves[q]:
                    steps.append((moves[q][initial], c + more, a + "K"))
            for x, d, b in steps:
                new[x] = min(new.get(x, (d, b)), (d, b))
        t = inserted(new)
    return min(t[q] for q in (0, 3) if q in t)


def test_search_equals_enumeration():
    r = random.Random(1)
    for _ in range(250):
        items = [(r.choice("KKKTD"), r.choice("uuaasx")) for _ in range(r.randint(0, 4))]
        assert convrepair.search([(k, i, 1) for k, i in items], 0, convrepair.WHOLE) == cheapest(items) == automaton(items)


def test_search_equals_tables_on_long_conversations():
    r = random.Random(2)
    for n in (5, 20, 300, 1024):
        for mix in ("KKKTD", "KKKKKKKKT", "T", "K"):
            items = [(r.choice(mix), r.choice("uauauasx" if n % 2 else "uaua")) for _ in range(n)]
            assert convrepair.search([(k, i, 1) for k, i in items], 0, convrepair.WHOLE) == automaton(items)


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how:
            row = (c, t, "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text)
            out += [row] * (2 if how == 3 else 1)
    return out


def report(rows):
    out = []
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in after if r[0] == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, items = set(), []
        faults = Counter()
        for t, role, text in own:
            bare = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            items.append(({"": "K", "truncated": "T"}.get(fault, "D"), role[:1]))
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in itertools.pairwise(items))
        turns = [t for t, _, _ in own if t is not None]
        cost, audit = automaton(items)
        kept, i = [], 0
        for letter in audit:
            if letter == "I":
                kept.append(None)
            else:
                if letter != "D":
                    kept.append((letter, *own[i][1:]))
                i += 1
        at = len(kept) % 2
        repaired = []
        for j, row in enumerate(kept):
            who = "system" if at and j == 0 else ("user", "assistant")[(j - at) % 2]
            repaired.append(f"{who}:" if row is None else f"{row[1]}:{row[2]}" if row[0] == "K" else f"{who}:{row[2]}")
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
                    illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return out


def conversations(seed=6):
    r = random.Random(seed)
    rows = []
    for c in range(150):
        t = r.randint(-3, 3)
        for j in range(r.randint(1, 9)):
            t += r.choice([1, 1, 1, 2, 0])
            rows.append((c, t, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]) if c % 3 else ("user", "assistant")[j % 2],
                         r.choice(["yes.", "no!", "why?  ", "cut", " \n", "", None, f"text {j}.", "ok.  ", "a\nb."])))
    long = [(999, j, ("user", "assistant")[j % 2], f"line {j}" + (".", "", "!")[j % 3 if j % 7 == 0 else 0]) for j in range(700)]  # over several segments
    odd = [(None, None, "user", "hi."), (None, None, "user", "hi."), (None, 4, "assistant", "x" * 300_000 + "."), (500, None, None, None),
           (501, 1, "user", "a."), (501, 1, "user", "a."), (501, 1, "user", "a."), (501, 2, "assistant", "b."), (502, -(1 << 62), "user", "a."), (502, (1 << 61), "user", "b.")]
    rows += long + odd + rows[:5]
    gone = next(c for c in range(2000, 4000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((gone, 1, "user", "lost."))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_repair_equals_brute_force(spark, monkeypatch, small):
    if small:  # long conversations over many segments, joined in rounds
        monkeypatch.setattr(convrepair, "SEGMENT", 4)
        monkeypatch.setattr(convrepair, "FAN", 3)
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("x")).withColumn("conv", F.lit(1)).repartition(3)
    got = {r["conv_id"]: tuple(r) for r in convrepair.repair_report(df).collect()}
    want = {r[0]: r for r in report(rows)}
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c]


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "be kind."), (1, 1, "assistant", "hello."), (1, 2, "assistant", "hello."), (1, 3, "user", "bye."), (2, 0, "tool", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = convrepair.repair_conversations(df)
    assert {(x["conv_id"], x["cost"], x["audit"], x["illegal"], x["duplicate"]) for x in r.summary.collect()} == {(1, 4, "KRDR", 2, 1), (2, 2, "D", 0, 0)}
    assert sorted(tuple(x) for x in r.repaired_turns().collect()) == [
        (1, 0, "K", "system", "be kind."), (1, 1, "R", "user", "hello."), (1, 3, "R", "assistant", "bye.")]


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert convrepair.repair_report(df).count() == 0
    assert convrepair.repair_report(df).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
