"""The training-data operators against brute force, on small tables with
nulls, empty and long texts, ties, repeated rows and clashing column names."""

import gzip
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, components, credentials, decontam, jaccard, linededup, mixing, pii, quality, queries, toxicity, warc
from tessera.llm.text import word_hashes, word_hashes_of
from tests.conftest import SF001, SF01

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
#: names that the operators use inside
CLASH = "n int, th string, words string, row string, _size string, score string, cls string, a string, gone string"


def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed=1):
    """(doc_id, text, source) rows: copies, near copies, shared lines and passages, odd texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgé", k=r.randint(2, 6))) for _ in range(300)]
    line = lambda n: " ".join(r.choices(vocabulary, k=n))
    rows = [(i, "\n".join(line(r.randint(1, 25)) for _ in range(r.randint(1, 6)))) for i in range(60)]
    base = line(60)
    for i in range(60, 80):  # near copies
        w = base.split()
        w[r.randrange(60)] = "changed"
        rows.append((i, " ".join(w)))
    common = line(12)
    for i in range(80, 95):  # a common line, once with one word more, less or other
        w = common.split()
        rows.append((i, line(9) + "\n" + " ".join([w, w[:3] + w[4:], w[:5] + ["more"] + w[5:], w[:7] + ["other"] + w[8:]][i % 4])))
    rows += [(95, None), (96, ""), (97, "?!"), (98, "?!"), (99, "!?"), (100, " \n\t "), (101, "One"), (102, "one."), (103, rows[3][1].upper()),
             (104, line(6000)), (105, rows[5][1]), (None, line(30)), (None, None)]
    rows = [(i, t, None if i is not None and i % 17 == 0 else f"s{(i or 0) % 4}") for i, t in rows]
    return rows + [rows[7]]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in CLASH.split(", "):
        df = df.withColumn(c.split()[0], F.lit(None).cast(c.split()[1]))
    return df.withColumn("lang", F.lit("xx")).repartition(3)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(i, 1, 0) for i, _, _ in rows if i is not None and i % 3], "doc_id long, quality int, toxic int")


# --- 1: chat -----------------------------------------------------------------

def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "<\\s><\\\\/s>[\\INST][TEXT]", "", None, "a\nb", "<<s>>[[INST]]", "\\", "é" * 5000, "x [TEXT] y"]
    turns = [(1, i, "user" if i % 3 else "assistant", t) for i, t in enumerate(hard)]
    turns += [(2, 0, None, "t"), (2, 0, "[/INST]", "u"), (2, None, "user", "first"), (None, 1, "user", "z"), (1, 3, "user", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("s", F.lit(1)).withColumn("a", F.lit(2))
    out = chat.format_chat(df.repartition(4))
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["p"]] for r in out.withColumn("p", chat.parse_chat(F.col("formatted"))).collect()}
    first = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in (1, 2, None):
        want = [(t[2] or "", t[3] or "") for t in sorted((t for t in turns if t[0] == conv), key=first)]
        assert got[conv] == want
    digest = {r["conv_id"]: r for r in chat.chat_digest(out).collect()}
    said = "".join(t[3] or "" for t in sorted((t for t in turns if t[0] == 1), key=first) if t[2] == "assistant")
    assert digest[1]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and digest[1]["loss_chars"] == len(said)
    assert digest[1]["n_blocks"] == len([1 for _ in itertools.groupby(sorted((t for t in turns if t[0] == 1), key=first), lambda t: t[2])])
    assert chat.chat_digest(chat.format_chat(df.limit(0))).count() == 0


# --- 2: secrets --------------------------------------------------------------

def brute_secrets(text):
    out = []
    for k, p in enumerate((r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+")):
        for m in re.finditer(p, text, re.A):
            if len(m[2] if k == 0 else m[0]) >= (6, 20, 24)[k]:
                out.append((m.start(), k, f"{('assign', 'access', 'hex')[k]}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_secret_spans_match_brute_force():
    r = random.Random(3)
    parts = ["password=", "PassWord\" : '", "api_key:", "apikey = ", "token", "=", "AKIA" + "A" * 16, "AKIA123", "0123456789abcdef" * 2, "abcdef0",
             "x.y/z+1", " ", "\n", "é", "secret: hunter", "ſecret=abcdefgh", "toKen=abcdefgh"]
    for _ in range(500):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert [f"{k}:{a}:{b}" for a, b, k in credentials.base_spans(text)] == brute_secrets(text)


def test_guess_costs():
    weak = [credentials.log10_guesses(v) for v in ("password", "aaaaaaaaaaaa", "qwertyuiop", "20240131", "Password1", "")]
    strong = [credentials.log10_guesses(v) for v in ("x9K!vQ2#mZ7p", "b7db7aa4a5fcc78305")]
    assert max(weak) < credentials.MIN_LOG10_GUESSES <= min(strong) and weak[-1] == 0
    assert credentials.log10_guesses("ab" * 20000) > 0  # linear time
    assert [s[:3] for s in credentials.guess_spans('pwd: "x9K!vQ2#mZ7p" and pwd: password')] == [(6, 18, "guess")]
    assert credentials.guess_spans("the secret of the thing; pass on") == []


def test_context_behind_a_rejected_value():
    found = lambda t: [t[a:b] for a, b, _, _ in credentials.guess_spans(t)]
    for token in ("mF_9.B5f-4.1JqM", "dXNlcjpodW50ZXI0Mg==", "xkqzvbWJHPGM"):
        for scheme in ("Bearer", "Basic", "Token", "bearer ", "Negotiate"):
            for text in (f"Authorization: {scheme} {token}", f'{{"Authorization": "{scheme} {token}"}}', f"-H 'Proxy-Authorization: {scheme} {token}'"):
                assert found(text) == [token], text
    assert found("auth passphrase: x9K!vQ2#mZ7p") == ["x9K!vQ2#mZ7p"]
    assert found("password: password token: b7db7aa4a5fcc78305") == ["b7db7aa4a5fcc78305"]
    assert found("token: Bearer mF_9.B5f-4.1JqM and Authorization: Bearer x") == ["mF_9.B5f-4.1JqM"]
    assert found("Authorization: Bearer") == [] and found("the secret token and the password phrase") == []
    assert len(found("token=" * 50_000)) == 1 and found("pass " + "a-" * 50_000 + "pwd: ") == []  # linear time


def test_cheapest_cut_is_exact():
    """The recurrence against a search over all cuts into the same kinds of spans."""
    def spans(v):
        n = len(v)
        for i in range(n):
            for j in range(i + 1, n + 1):
                p, first = v[i:j], math.log10(2) if i else 0.0
                costs = [sum(map(credentials._brute, p))]
                if len(set(p)) == 1:
                    costs.append(credentials._brute(p[0]) + 0.3 + (len(p) - 1) * math.log10(1.3))
                if all((a, b) in credentials._STEP for a, b in zip(p.lower(), p.lower()[1:])):
                    costs.append(math.log10(47) + (len(p) - 1) * math.log10(1.8))
                if p in credentials.WORDS and len(p) >= 3:
                    costs.append(credentials._RANK[p])
                if len(p) in credentials.DATE_LENGTHS and credentials.DATE.fullmatch(p):
                    costs.append(credentials._YEARS + (math.log10(365) if len(p) > 4 else 0))
                yield i, j, min(costs) + first
    for v in ("abc1999zz", "qwerzzz", "love2020x", "aaab", "key0101"):
        best = [0.0] + [math.inf] * len(v)
        for i, j, c in sorted(spans(v), key=lambda s: s[1]):
            best[j] = min(best[j], best[i] + c)
        assert credentials.log10_guesses(v) == pytest.approx(best[-1])


def test_secret_table(spark, docs):
    assert credentials.scan_secrets(docs).count() == docs.count()
    assert credentials.scan_secrets(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "token=abcdef1234 é password: b7db7aa4a5fcc78305."), (2, None)], "doc_id long, text string")
    r = {x["doc_id"]: x for x in credentials.scan_secrets(one).collect()}
    assert (r[1]["n_assign"], r[2]["n_assign"], r[2]["spans"]) == (2, 0, "") and "guess:" in r[1]["spans"]
    clean = {x["doc_id"]: x["text"] for x in credentials.redact_secrets(one).collect()}
    assert "b7db" not in clean[1] and "é" in clean[1] and clean[2] is None


# --- 3: personal data --------------------------------------------------------

def brute_personal(text):
    out = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(f"card:{m.start()}:{m.end()}")
    return out + [f"phone:{m.start()}:{m.end()}" for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_personal_spans_match_brute_force():
    r = random.Random(4)
    parts = ["a.b", "@", "x-y", ".", "com", "1", "255", "256", "0001", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+", " ", "-", "é", "\n", "12"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)] == brute_personal(text), text
    pii.base_spans("1" * 200_000 + "a@" * 50_000)  # no quadratic runs


def test_disclosing_terms(spark, docs):
    rows = [(i, f"call Zorblatt at +1 555 010 99{i:02d} today please ok") for i in range(20)]
    rows += [(100 + i, "today please call ok at the desk, nothing else here") for i in range(300)] + [(999, None), (1000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x")).withColumn("id", F.lit(1))
    got = {r["doc_id"]: r for r in pii.scan_personal_data(df).collect()}
    assert got[3]["n_phone"] == 1 and got[3]["spans"].split(",")[1] == "term:5:13" and got[100]["spans"] == "" and got[999]["n_term"] == 0
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert clean[3] == "call  at [phone] today please ok" and clean[150] == rows[70][1] and clean[999] is None
    assert pii.scan_personal_data(docs).count() == docs.count() and pii.scan_personal_data(docs.limit(0)).count() == 0


def test_terms_far_from_their_entity(spark, monkeypatch):
    """A name ten words and a paragraph from its number, in three documents only; and terms in blocks."""
    filler = [f"some plain filler words that every one of them has {i}" for i in range(3)]
    rows = [(None if i == 0 else i, f"Zorblatt {filler[i]} +1 555 010 99{i:02d}\nthen Quxley, xzorblatt zorblatt") for i in range(3)]
    rows += [(100 + i, f"{filler[i % 3]} then xzorblatt") for i in range(300)] + [rows[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {f"term:{m.start()}:{m.end()}" for m in re.finditer("(?i)\\b(zorblatt|quxley)\\b", rows[1][1])}
    for size in (pii.TERMS_PER_PASS, 1):
        monkeypatch.setattr(pii, "TERMS_PER_PASS", size)
        got = [r for r in pii.scan_personal_data(df).collect()]
        assert len(got) == len(rows) and len(want) == 3
        for r in got:
            assert set(r["spans"].split(",")[1:]) == (want if r["n_phone"] else set()) and r["n_term"] == (3 if r["n_phone"] else 0)
    assert "orblatt +" not in "".join(r["text"] for r in pii.sanitise(df).where("text LIKE '%[phone]%'").collect())
    text = "é1.2.3.4x a@b.co, ok+1 (555) 010-9999é z"
    plain = pii.masked(text, pii.base_spans(text))
    assert len(plain) == len(text) and plain.split() == [",", "ok", "z"]


# --- 4: quality --------------------------------------------------------------

def brute_signals(text):
    w = plain(text)
    seen = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + j for i, x in enumerate(seen) if seen.count(x) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if plain(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_quality_counts_match_brute_force(docs, labels, rows):
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choices(["a ", "b ", "é ", "\n", "#", "\x1c", "a b a\n", "\t", "\x85"], k=r.randint(0, 30)))
        assert quality.text_signals(text)[:5] == brute_signals(text), repr(text)
    got = quality.judge_quality(docs, labels).collect()
    want = {i: brute_signals(t) for i, t, _ in rows if i is not None and i != 104}
    assert len(got) == len(rows)
    for x in got:
        if x["doc_id"] in want:
            assert tuple(x[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want[x["doc_id"]]
        n = x["n_words"]
        assert x["base_failed"] == (n < 50 or 100 * x["n_repeat_words"] > 50 * n) and not (x["base_failed"] and x["kept"])
    assert quality.judge_quality(docs.limit(0), labels).count() == 0
    assert quality.judge_quality(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_binomial_bound_and_cutoffs():
    assert quality.binomial_tail(2, 10, 0.3) == pytest.approx(sum(math.comb(10, i) * 0.3 ** i * 0.7 ** (10 - i) for i in range(3)))
    cells = [{"cell": 0, "good": 20000, "bad": 0}, {"cell": 10, "good": 30, "bad": 5}, {"cell": 30, "good": 0, "bad": 500}]
    assert quality.best_cutoff(cells, 1, 0.01, 0.05) == quality.GRID[29]  # the highest that rejects all of the clear cases
    assert quality.best_cutoff([{"cell": 0, "good": 20, "bad": 0}, {"cell": 30, "good": 0, "bad": 9}], 1, 0.01, 0.05) is None  # too few to prove


# --- 5: Jaccard join ---------------------------------------------------------

def brute_links(rows, n=5, least=0.8):
    """Links of each row and the first row of its class."""
    sets = []
    for _, t, _ in rows:
        w = folded(t)
        k = min(n, len(w))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else t or "")
    link = lambda a, b: a == b if isinstance(a, str) or isinstance(b, str) else len(a & b) >= least * len(a | b) - 1e-9
    near = [[j for j in range(len(sets)) if j != i and link(sets[i], sets[j])] for i in range(len(sets))]
    root = [None] * len(rows)
    for i in range(len(rows)):
        todo = [i] if root[i] is None else []
        while todo:
            x = todo.pop()
            if root[x] is None:
                root[x] = i
                todo += near[x]
    return near, root


def brute_classes(rows, n=5, least=0.8):
    near, root = brute_links(rows, n, least)
    ids = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            ids[root[i]] = min(ids.get(root[i], d), d)
    return sorted(((d, ids.get(root[i]), len(near[i])) for i, (d, _, _) in enumerate(rows)), key=str)


def test_jaccard_classes_match_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 6)  # many blocks
    got = jaccard.jaccard_classes(docs).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=str) == brute_classes(rows)
    assert jaccard.jaccard_classes(docs.limit(0)).count() == 0
    one = jaccard.keep_one_per_class(docs)
    least = {}
    for (d, _, _), r in zip(rows, brute_links(rows)[1]):
        least[r] = min(least.get(r, (True, 0)), (d is None, d or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in one.collect()) == sorted(least.values())  # one row of every class
    assert one.columns == docs.columns


def test_rows_of_one_id_are_told_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a, "x"), (1, b, "x"), (1, b, "x"), (None, a + " more", "y"), (None, "only one", "z"), (None, None, None), (2, "", "e")],
                               "doc_id long, text string, _th string")
    got = sorted(map(tuple, jaccard.keep_one_per_class(df).collect()), key=str)
    empty = [t for t in got if not t[1]]  # the null and the empty text are copies
    assert [t for t in got if t[1]] == sorted([(1, a, "x"), (1, b, "x"), (None, "only one", "z")], key=str) and empty == [(2, "", "e")]


def test_null_ids_fetch_their_own_texts(spark, monkeypatch):
    """Candidates without a doc_id, or of one, meet no other rows' texts."""
    words = [f"w{i}" for i in range(100)]
    rows = [(None if i % 2 else 7, " ".join(words[:i] + ["changed"] + words[i + 1:])) for i in range(0, 90, 3)]
    df, fetched, plain_map = spark.createDataFrame(rows + rows[:1], "doc_id long, text string"), [], jaccard.map_texts

    def spy(frame, fn, keys, *more):
        if keys == ["_cls"]:
            fetched.append(frame.count())
        return plain_map(frame, fn, keys, *more)

    monkeypatch.setattr(jaccard, "map_texts", spy)
    got = jaccard.jaccard_classes(df).collect()
    assert fetched == [len(rows) + 1] and len(got) == len(rows) + 1 and {(r["class_id"], r["n_links"]) for r in got} == {(7, len(rows))}


def test_bands_reach_the_target():
    bands, k = jaccard.choose_bands()
    assert 1 - (1 - 0.8 ** k) ** bands >= jaccard.TARGET_RECALL and bands * k <= jaccard.MAX_HASHES
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.01, 0.999, 10)


def test_word_hashes():
    texts = ["Ab é-x", "", "ab", "é", "x" * 10, "AB\x00x"]
    h, at = word_hashes_of(texts)
    parts = [list(h[a:b]) for a, b in zip(at, at[1:])]
    assert [len(p) for p in parts] == [len(folded(t)) for t in texts] and parts[0][0] == parts[2][0] and parts[0][1] == parts[3][0]
    long = "wörd " * 300_000
    assert len(word_hashes(long.encode())) == 300_000 and len(np.unique(word_hashes(long.encode()))) == 1


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1300)] + [(5, 5), (None, 3)]
    got = {x["node"]: x["root"] for x in components.connected_components(spark.createDataFrame(edges, "x long, y long")).collect()}
    root = {}
    for a, b in edges:
        if a is not None:
            root.setdefault(a, a), root.setdefault(b, b)
            x, y = sorted((root[a], root[b]))
            root = {k: x if v == y else v for k, v in root.items()}
    assert got == {k: v for k, v in root.items() if k != v}


# --- 6: decontamination ------------------------------------------------------

def test_contamination_matches_brute_force(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 2000)  # several passes
    texts = [t for _, t, _ in rows if t and len(folded(t)) > 12]
    items = [(1, texts[2]), (2, " ".join(folded(texts[5])[2:14])), (3, folded(texts[0])[0]), (4, " ".join(folded(texts[1])[:2])), (5, None), (6, "?"),
             (10, texts[2]), (None, " ".join(folded(texts[8])[-4:])), (7, "nowhere to be found at all in any of the documents")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    want = []
    for d, t, _ in rows:
        w, hit, ids = folded(t), set(), set()
        for i, x in items:
            b = folded(x)
            k = min(10, len(b))
            wins = {tuple(b[j:j + k]) for j in range(len(b) - k + 1)} if b else ()
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in wins:
                    hit |= set(range(j, j + k))
                    ids.add(i)
        named = sorted(str(i) for i in ids if i is not None)
        want.append((d, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    got = [tuple(r) for r in decontam.contamination(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert decontam.drop_contaminated(docs, bench).count() == sum(not x[5] for x in want)
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


# --- 7: mixing ---------------------------------------------------------------

def test_knapsack_is_exact():
    r = random.Random(7)
    for _ in range(150):
        lengths = r.sample(range(1, 30), r.randint(1, 5))
        counts = [r.randint(0, 3) for _ in lengths]
        budget = r.randint(0, 80)
        take = mixing.bounded_knapsack(np.array(lengths), np.array(counts), budget)
        best = max(s for c in itertools.product(*[range(n + 1) for n in counts]) if (s := sum(a * b for a, b in zip(c, lengths))) <= budget)
        assert (take <= counts).all() and sum(take * lengths) == best


def test_mix_meets_targets(docs, rows):
    out = mixing.mix_sources(docs).select("doc_id", "source", "_size", "_source_size", "_target", "_taken").collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(plain(t))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), float(sum(size.values()))
    while True:
        total = sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and left * weight[s] / total > 3 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            full.add(s)
        left = sum(size.values()) - sum(target[s] for s in full)
    target |= {s: left * weight[s] / total for s in names if s not in full}
    taken = dict.fromkeys(names, 0)
    assert len(out) == len(rows)
    for r in out:
        assert r["_source_size"] == size[r["source"]] and r["_target"] == pytest.approx(target[r["source"]]) and r["_taken"] <= 3 * r["_size"]
        taken[r["source"]] += r["_taken"]
    for s in names:  # short documents are there, so the budget is met but for the rounding
        # all but the 6000-word text that is longer than its source's whole target
        assert abs(taken[s] - target[s]) <= 1 or s == "s0" and taken[s] == 3 * (size[s] - 6000), (s, taken[s], target[s])
    again = mixing.mix_sources(docs.repartition(5)).select("doc_id", "_taken").collect()
    assert sorted(map(str, again)) == sorted(str(type(again[0])(doc_id=r["doc_id"], _taken=r["_taken"])) for r in out) or \
        sorted((str(r["doc_id"]), r["_taken"]) for r in again) == sorted((str(r["doc_id"]), r["_taken"]) for r in out)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_hot_lengths_are_split(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANK_GROUP", 10)
    df = spark.createDataFrame([(i, "a b c", "x" if i < 400 else "y") for i in range(600)], "doc_id long, text string, source string")
    out = mixing.mix_sources(df).groupBy("source").agg(F.sum("_taken").alias("t"), F.first("_target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) <= 3 for r in out)


# --- 8: WARC -----------------------------------------------------------------

def strict_members(files):
    for data in [p.read_bytes() for p in files]:
        while data:
            assert data[:2] == b"\x1f\x8b"
            inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
            yield inflate.decompress(data)
            assert inflate.eof
            data = inflate.unused_data


def test_warc_round_trip(spark, tmp_path):
    pages = [(3, "u v", "x" * 150), (1, None, "x" * 150), (2, "w", "é" * 50), (4, "w", "é" * 50), (5, "s", "short"), (6, "s", "short"), (7, "n", None),
             (None, "q", "x" * 150), (8, "big", "\r\n\r\n" + "WARC/1.1\x00" * 40000), (9, "16 MB", "z" * (1 << 24)), (1, "again", "x" * 150)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    folder = str(tmp_path / "a")
    warc.write_archives(warc.plan_records(df.repartition(2)), folder)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, folder).collect()), key=str)
    first = {"x" * 150: 1, "é" * 50: 2}
    want = []
    for i, _, h in pages:
        ref = first.get(h) if first.get(h) != i else None
        b = (h or "").encode()
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if ref else "response", ref))
    assert got == sorted(want, key=str)
    whole = b"".join(strict_members((tmp_path / "a").glob("part-*")))  # members and nothing between
    assert whole.count(b"WARC-Type: revisit") == sum(w[3] == "revisit" for w in want)
    empty = str(tmp_path / "b")
    warc.write_archives(warc.plan_records(df.limit(0)), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_damaged_archives_are_refused():
    m = warc.record_member(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), "response", None)
    assert warc.read_record(next(warc.members_of(m + b"\0" + m, 7)))["block"] == b"hello" and len(list(warc.members_of(m + b"\0" + m, 7))) == 2
    plain_record = gzip.decompress(m)
    for bad in (plain_record.replace(b"hello", b"jello"), plain_record.replace(b"Content-Length: 5", b"Content-Length: 4"), b"WARC/0.1\r\n\r\n", b"x"):
        with pytest.raises(warc.BadRecord):
            warc.read_record(bad)
    for cut in (m[:-3], m[:20] + b"\xff\xff" + m[22:]):
        with pytest.raises(warc.BadRecord):
            [warc.read_record(x) for x in warc.members_of(cut)]


# --- 9: line dedup -----------------------------------------------------------

def test_line_dedup_matches_brute_force(docs, rows):
    lines = sorted({(d, i, tuple(plain(x))) for d, t, _ in rows if t is not None and d is not None for i, x in enumerate(t.split("\n"))})
    lines = [x for x in lines if len(x[2]) >= 5]

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    gone = {(d, i) for k, (d, i, w) in enumerate(lines) if any(near(w, v) for _, _, v in lines[:k])}
    some = docs.where("doc_id IS NOT NULL")
    got = {(r["doc_id"], r["line_no"]) for r in linededup.near_lines(some).collect()}
    assert got == gone and len(gone) > 10
    out = linededup.dedupe_lines(some).select("doc_id", "text", "_n_lines", "_n_removed").distinct().collect()
    texts = {d: t for d, t, _ in rows if d is not None}
    assert {r["doc_id"] for r in out} == set(texts)
    for r in out:
        t = texts[r["doc_id"]]
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (r["doc_id"], i) not in gone)
        assert r["text"] == kept and r["_n_lines"] == (0 if t is None else t.count("\n") + 1)
    assert linededup.dedupe_lines(docs).count() == len(rows) and linededup.dedupe_lines(docs.limit(0)).count() == 0


def test_line_dedup_tells_rows_of_one_id_apart(spark):
    r = random.Random(9)
    vocabulary = [f"v{i}" for i in range(12)]
    line = lambda: " ".join(r.choices(vocabulary, k=r.randint(4, 6)))
    pool = [line() for _ in range(12)]
    rows = [(None if i % 3 == 0 else i % 5, "\n".join(r.choice(pool) if r.random() < 0.3 else line() + " " + r.choice("xyz") * 3 + str(i) + " u" + str(j)
                                                      for j in range(r.randint(1, 5)))) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    th = {x["text"]: x["th"] for x in df.select("text", F.xxhash64("text").alias("th")).collect()}
    order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    lines = sorted({(d, th[t], i, tuple(plain(x))) for d, t in rows for i, x in enumerate(t.split("\n")) if len(plain(x)) >= 5}, key=order)

    def near(a, b):
        a, b = sorted((a, b), key=len)
        return sum(x != y for x, y in zip(a, b)) <= 1 if len(a) == len(b) else any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    gone = {x[:3] for k, x in enumerate(lines) if any(near(x[3], y[3]) for y in lines[:k])}
    assert {tuple(x) for x in linededup.near_lines(df).select("doc_id", "th", "line_no").collect()} == gone and len(gone) > 10
    want = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if (d, th[t], i) not in gone)) for d, t in rows]
    assert sorted(map(repr, map(tuple, linededup.dedupe_lines(df).select("doc_id", "text").collect()))) == sorted(map(repr, want))


def test_long_lines_of_few_words(spark):
    import corpus_pipeline

    chinese, link, brief = "本网站内容版权归原作者所有未经许可不得转载违者必究", "https://example.org/a/very/long/path?x=1", "read more"
    rows = [(i, f"own line {i}\n{chinese}\n{link}  ok\n{brief}\n{' ' * 30}", "xx", "s", 1) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, df, "").collect()}
    assert got == {i: t if i == 0 else f"own line {i}\n{brief}\n{' ' * 30}" for i, t, *_ in rows}
    assert linededup.near_lines(df).count() == 0  # the floor of op9_line_dedup's SQL


# --- 10: toxicity ------------------------------------------------------------

def test_grammar_weighs_clauses():
    lexicon, machine = toxicity.Lexicon({"idiot": 5.0, "=zog": 4.0}), toxicity.grammar()
    score = lambda t: toxicity.clause_scores(t, lexicon, machine)
    assert score("what an idiot") == [5.0] and score("you are an IDIOTIC one") == [6.0]
    assert score("that is not idiot") == [pytest.approx(2.0)] and score("he said idiot") == [pytest.approx(3.6)]
    assert score("I will kill you") == [toxicity.THREAT_WEIGHT] and score("they kill time. I will not hurt") == []
    assert score("zog. zogs. zog") == [4.0, 4.0] and score("") == [] and score("fine") == []


@pytest.mark.parametrize("sf", [SF01])
def test_held_out_accuracy(spark, sf):
    out = queries.REGISTRY["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = (out["predicted"] == 1) & (out["toxic"] == 1)
    assert ((out["predicted"] == 1) & (out["toxic"] == 0)).sum() == 0 and hit.sum() >= 0.5 * (out["toxic"] == 1).sum()
    assert out["score"].between(0, 1).all()


def test_toxicity_of_odd_tables(docs, labels):
    assert toxicity.score_toxicity(docs, labels).count() == docs.count()  # no toxic label at all
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_held_out_rule(spark):
    import zlib

    got = {r["doc_id"]: r["h"] for r in spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


# --- SQL ---------------------------------------------------------------------

@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for t in "documents pages conversations benchmark labels embeddings".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    want = con.execute(queries.SQL[key])
    names = [d[0] for d in want.description]
    got = queries.REGISTRY[key](spark, SF001)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
