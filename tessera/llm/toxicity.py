"""Toxicity by a weighted finite-state pattern grammar.

Clauses are tapes of word classes: insult, threat verb, intent, target,
negation, reporting verb. Four transducers are composed into one: negation and
reported speech weaken what they govern, a target close by strengthens it, and
a threat is an intent followed by a threat verb. The score of a clause is the
sum of the weights of its insults times their factors, and of its threats.

What counts as an insult is learned: words and word beginnings that mark
toxic texts among labelled rows, chosen by greedy cover, weighted by log odds.
A logistic curve over the clause scores gives the probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import map_texts

#: labelled texts that the lexicon and the curve are learned from, about; a hash of doc_id picks them
MAX_TRAINING_TEXTS = 10_000
#: lengths of word beginnings that may become lexicon entries, besides whole words
PREFIXES = (4, 5, 6)
#: an entry marks so many toxic texts at least, and clean texts at this share at most
MIN_TOXIC, MAX_CLEAN_SHARE = 5, 0.1
#: chance that a word of no meaning passes the test below, over all words together
FALSE_ENTRIES = 0.01
MAX_ENTRIES = 400
#: share of all toxic texts that copies of a few texts don't reach
COMMON = 0.15
THRESHOLD = 0.3
#: base rate without any label
PRIOR = 0.05

# fixed values: closed word classes of English, German, French and Spanish
TARGETS = frozenset("you your yours yourself u ur they them he she him her du dich dir dein deine ihr euch sie tu te toi ton ta "
                    "vous votre vos tú ti tus usted ustedes vosotros os".split())
NEGATIONS = frozenset("not no never nobody nothing neither nor isn aren wasn weren don doesn didn won can't nicht kein keine "
                      "keinen niemals nie pas jamais aucun aucune nunca jamás ningún ninguna tampoco".split())
REPORTS = frozenset("said says say told called calls wrote writes quoted quotes claimed reported sagt sagte nannte nennt schrieb "
                    "behauptet dit disait appelé appelle écrit prétend dijo dice llamó llama escribió afirma".split())
INTENTS = frozenset("will shall gonna going must ll werde werden wird muss vais va vas allons voy vamos voya".split())
THREATS = frozenset("kill hurt destroy murder beat stab shoot töten umbringen verletzen erschießen tuer frapper détruire "
                    "poignarder matar golpear destruir apuñalar".split())

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")

INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, OTHER = "ITMYNR-"
CLASSES = (INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, OTHER)
#: words that a negation governs, and that may stand between a target and an insult
NEGATION_SPAN, TARGET_SPAN = 3, 4


class Transducer:
    """A deterministic weighted transducer: ``step[state, symbol]`` is
    (state, symbol put out, factor). Symbols without a step pass unchanged
    by ``otherwise[state]``, the next state."""

    def __init__(self, step: dict, otherwise: dict):
        self.step, self.otherwise = step, otherwise

    def at(self, state, symbol):
        return self.step.get((state, symbol)) or (self.otherwise[state], symbol, 1.0)

    def compose(self, other: "Transducer", alphabet: tuple) -> "Transducer":
        """The transducer that gives this one's output to ``other``, over all
        reachable pairs of states; factors multiply."""
        step, todo, seen = {}, [(0, 0)], {(0, 0)}
        ids = {(0, 0): 0}
        while todo:
            pair = todo.pop()
            for symbol in alphabet:
                a, middle, x = self.at(pair[0], symbol)
                b, out, y = other.at(pair[1], middle)
                if (a, b) not in seen:
                    seen.add((a, b))
                    ids[a, b] = len(ids)
                    todo.append((a, b))
                step[ids[pair], symbol] = (ids[a, b], out, x * y)
        return Transducer(step, {i: i for i in ids.values()})


def negation() -> Transducer:
    step: dict = {}
    for left in range(NEGATION_SPAN + 1):
        step[left, NEGATION] = (NEGATION_SPAN, NEGATION, 1.0)
        if left:
            step[left, INSULT] = (left - 1, INSULT, 0.4)
            step[left, THREAT] = (left - 1, OTHER, 1.0)  # "will not hurt" is no threat
    return Transducer(step, {left: max(0, left - 1) for left in range(NEGATION_SPAN + 1)})


def reported() -> Transducer:
    step = {(0, REPORT): (1, REPORT, 1.0), (1, INSULT): (1, INSULT, 0.6), (1, THREAT): (1, THREAT, 0.6)}
    return Transducer(step, {0: 0, 1: 1})


def targeted() -> Transducer:
    step: dict = {}
    for left in range(TARGET_SPAN + 1):
        step[left, TARGET] = (TARGET_SPAN, TARGET, 1.0)
        if left:
            step[left, INSULT] = (left - 1, INSULT, 1.2)
    return Transducer(step, {left: max(0, left - 1) for left in range(TARGET_SPAN + 1)})


def threatening() -> Transducer:
    """A threat verb counts only after an intent in its clause."""
    step = {(0, INTENT): (1, INTENT, 1.0), (0, THREAT): (0, OTHER, 1.0)}
    return Transducer(step, {0: 0, 1: 1})


def grammar() -> Transducer:
    whole = negation()
    for part in (reported(), targeted(), threatening()):
        whole = whole.compose(part, CLASSES)
    return whole


class Lexicon:
    """Learned entries: ``=word`` is a whole word, others are beginnings."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        stems = sorted({e.lstrip("=") for e in weights} | THREATS)
        self.quick = re.compile("|".join(map(re.escape, stems))) if stems else None

    def weight(self, word: str) -> float:
        found = self.weights.get("=" + word, 0.0)
        for n in PREFIXES:
            if len(word) >= n:
                found = max(found, self.weights.get(word[:n], 0.0))
        return found


#: weight of a threat, against the log odds of insults
THREAT_WEIGHT = 4.0


def clause_scores(text: str, lexicon: Lexicon, machine: Transducer) -> list[float]:
    """Scores of the clauses with an insult or a threat, in order."""
    low = text.lower()
    if lexicon.quick is None or not lexicon.quick.search(low):
        return []
    out, at = [], 0
    for m in [*CLAUSE.finditer(low), None]:
        clause, at = low[at:m.start() if m else len(low)], m.end() if m else len(low)
        if not lexicon.quick.search(clause):
            continue
        state, score = 0, 0.0
        for word in WORD.findall(clause):
            weight = lexicon.weight(word)
            symbol = INSULT if weight else THREAT if word in THREATS else INTENT if word in INTENTS else NEGATION if word in NEGATIONS \
                else REPORT if word in REPORTS else TARGET if word in TARGETS else OTHER
            state, symbol, factor = machine.at(state, symbol)
            if symbol == INSULT:
                score += weight * factor
            elif symbol == THREAT:
                score += THREAT_WEIGHT * factor
        if score:
            out.append(score)
    return out


def clause_features(scores: list[float]) -> tuple[float, float]:
    """Strongest clause, and the sum of all on a logarithmic scale."""
    return (max(scores), math.log1p(sum(scores))) if scores else (0.0, 0.0)


def word_marks(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return {"=" + w for w in words if len(w) > 2} | {w[:n] for w in words for n in PREFIXES if len(w) >= n}


def count_marks(train: DataFrame) -> DataFrame:
    """``mark, toxic, clean``: texts with each word and word beginning, summed per batch first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                sums: dict[str, list[int]] = {}
                for text, y in zip(texts[at:at + 500], labels[at:at + 500]):
                    for mark in word_marks(text or ""):
                        sums.setdefault(mark, [0, 0])[0 if y else 1] += 1
                yield pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array([s[0] for s in sums.values()], pa.int64()),
                                                  pa.array([s[1] for s in sums.values()], pa.int64())], ["mark", "toxic", "clean"])

    return train.select("text", "toxic").mapInArrow(count, "mark string, toxic long, clean long").groupBy("mark").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def held_out() -> "F.Column":
    """Rows that are never learned from: crc32 of the doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


class ToxicityModel:
    """Lexicon and curve; learned by :func:`learn`."""

    def __init__(self, weights: dict[str, float], curve: tuple[float, float, float]):
        self.weights, self.curve = weights, curve

    def scorer(self):
        weights, (base, x, y) = self.weights, self.curve

        def score(texts: list[str]) -> dict[str, list]:
            lexicon, machine = Lexicon(weights), grammar()
            out = []
            for t in texts:
                a, b = clause_features(clause_scores(t, lexicon, machine))
                out.append(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, base + x * a + y * b)))))
            return {"score": out}

        return score


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_TEXTS) -> DataFrame:
    """``text, toxic`` of about ``limit`` labelled rows that are not held out, by
    hash of doc_id (all of them if there are fewer); each text once per label."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic").where(~held_out())
    share = min(1.0, limit / max(known.count(), 1))
    picked = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic").dropDuplicates()  # about `limit` ids


def learn(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_TEXTS) -> ToxicityModel:
    """Learn the lexicon and the curve from :func:`training_rows`.

    Reads ``doc_id, text`` and ``doc_id, toxic``; nothing else of the rows
    enters. A word is an entry if it marks more toxic texts than chance allows
    at the base rate (binomial test over all words) and few clean ones; of
    these, entries are taken while they cover toxic texts that none of the
    earlier ones marks, the widest first. Without toxic or clean rows the
    lexicon is empty and every score is the base rate.
    """
    from tessera.session import cut_lineage

    train = cut_lineage(training_rows(docs, labels, limit))
    sums = train.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, n = int(sums["t"] or 0), int(sums["n"])
    rate = (toxic + PRIOR) / (n + 1)
    if toxic == 0 or toxic == n:
        return ToxicityModel({}, (math.log(rate / (1 - rate)), 0.0, 0.0))
    marks = cut_lineage(count_marks(train).where(F.col("toxic") >= MIN_TOXIC))
    strong = marks.where(F.col("clean") <= MAX_CLEAN_SHARE * (F.col("toxic") + F.col("clean")))
    tests = max(marks.count(), 1)
    # rows of the bounded training set only; the test keeps words that all copies of a few texts share apart from signals
    strong = [(r["mark"], r["toxic"], r["clean"]) for r in strong.toLocalIterator()
              if chance(r["toxic"], r["toxic"] + r["clean"], toxic / n) <= FALSE_ENTRIES / tests]
    chosen = cover(train, {m: (a, b) for m, a, b in strong}, toxic)
    weights = {m: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (n - toxic + 1)) for m, a, b in strong if m in chosen}
    weights = {m: w for m, w in weights.items() if w > 0}

    def features(texts: list[str]) -> dict[str, list]:
        lexicon, machine = Lexicon(weights), grammar()
        pairs = [clause_features(clause_scores(t, lexicon, machine)) for t in texts]
        return {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}

    rows = map_texts(train, features, ["toxic"], "text", "a double, b double").toPandas()  # three numbers per training text
    return ToxicityModel(weights, fit_curve(rows[["a", "b"]].to_numpy(float), rows["toxic"].to_numpy(float)))


def chance(hits: int, n: int, rate: float) -> float:
    """P(X >= hits) for X binomial(n, rate)."""
    i = np.arange(hits, n + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) for k in i]
    return float(np.exp(np.array(logs) + i * math.log(rate) + (n - i) * math.log1p(-rate)).sum())


def cover(train: DataFrame, strong: dict[str, tuple[int, int]], toxic: int) -> set[str]:
    """Entries by greedy cover of the toxic training texts: each time the one
    that marks most texts not yet marked (ties: fewer clean texts, then word
    beginnings, the longer and then the later name), while it marks
    ``MIN_TOXIC`` new ones. Beginnings that mark ``COMMON`` of all toxic texts
    are entries even if their texts were covered already."""
    if not strong:
        return set()
    names = list(strong)
    place = {m: i for i, m in enumerate(names)}

    def marked(texts: list[str]) -> dict[str, list]:
        return {"m": [sorted(place[m] for m in word_marks(t) if m in place) for t in texts]}

    rows = map_texts(train.where("toxic = 1"), marked, ["toxic"], "text", "m array<int>").select("m").collect()  # toxic training texts
    texts_of: dict[int, set[int]] = {}
    for t, r in enumerate(rows):
        for m in r["m"]:
            texts_of.setdefault(m, set()).add(t)
    chosen, open_texts = set(), set(range(len(rows)))
    while len(chosen) < MAX_ENTRIES and texts_of:
        best = max(texts_of, key=lambda m: (len(texts_of[m] & open_texts), -strong[names[m]][1], names[m][0] != "=", len(names[m]), names[m]))
        if len(texts_of[best] & open_texts) < MIN_TOXIC:
            break
        chosen.add(names[best])
        open_texts -= texts_of.pop(best)
    rest = sorted((m for m in texts_of if names[m][0] != "=" and len(texts_of[m]) >= max(MIN_TOXIC, COMMON * len(rows))),
                  key=lambda m: (-len(names[m]), names[m]))
    for m in rest:  # longest first; a beginning of an entry with the same texts adds nothing
        if not any(c.startswith(names[m]) or names[m].startswith(c) for c in chosen):
            chosen.add(names[m])
    return chosen


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a ridge; base and two slopes."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(3)
    penalty = np.diag([1e-6, ridge, ridge])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Reads ``doc_id, text`` and ``doc_id, toxic``; other columns are ignored.
    Null and empty texts get the score of a text without matches; a null
    doc_id is scored and never learned from. Repeated rows get equal scores;
    an empty table gives no rows.
    """
    model = learn(docs, labels)
    scored = map_texts(docs, model.scorer(), ["doc_id"], "text", "score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    model = learn(docs, labels)
    rows = docs.select(F.struct("*").alias("row"), "text")  # packed, so that no column's name can clash
    scored = map_texts(rows, model.scorer(), ["row"], "text", "score double").where(F.col("score") < threshold)
    return scored.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
