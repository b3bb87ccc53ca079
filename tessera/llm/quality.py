"""Quality rules with risk-controlled cutoffs.

Each rule rejects texts whose signal is above a cutoff. The cutoff of a rule
in a stratum (a language) is the one of its grid that rejects most bad texts
among those for which labelled holdouts prove, by an exact binomial bound,
that they reject at most ``MAX_FALSE_REJECTION`` of the good texts; the bound's error probability is
shared out over all rules, strata and grid points (Bonferroni), so all chosen
cutoffs hold together with probability ``1 - DELTA``. Where no cutoff can be
proved, the rule doesn't reject there.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import map_texts

# fixed values: base rule of the contract
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: share of good texts that one rule may reject in one stratum
MAX_FALSE_REJECTION = 0.01
#: probability that any chosen cutoff breaks that
DELTA = 0.05
#: cutoffs tried for each signal, all of which lie in 0..1
GRID = tuple(round(0.02 * i, 2) for i in range(1, 50))
RULES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "short_text")
SPACES = " \t\n\v\f\r"


def text_signals(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_digits."""
    words = text.encode("utf-8", "surrogatepass").split()  # at space and \t \n \v \f \r only
    n = len(words)
    if not n:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0, 0)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    digits = sum(map(text.count, "0123456789"))
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), upper, digits)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    count, until = 0, 0  # words before `until` are counted
    for i, w in enumerate(windows):
        if seen[w] > 1:
            count += i + 3 - max(i, until)
            until = i + 3
    return count


def quality_signals(docs: DataFrame) -> DataFrame:
    """``doc_id, lang`` and the counts of every text; null texts have no words."""

    def measure(texts: list[str]) -> dict[str, list]:
        cols = list(zip(*map(text_signals, texts)))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits")
        return dict(zip(names, map(list, cols)))

    return map_texts(docs, measure, ["doc_id", "lang"], "text",
                     "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "n_lines long, n_upper long, n_digits long")


def rule_values() -> Column:
    """Array of the rules' signals, each in 0..1, in the order of ``RULES``."""
    share = lambda a, b: F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return F.array(share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
                   share("n_upper", "n_words"), share("n_digits", "word_chars"),
                   F.lit(1.0) / (F.lit(1.0) + F.col("n_words") / 10))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly in logarithms."""
    if n <= 0 or k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=float)
    steps = np.concatenate(([0.0], np.log((n - i[1:] + 1) / i[1:])))
    logs = np.cumsum(steps) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def risk_controlled_cutoffs(signals: DataFrame, labels: DataFrame, alpha: float = MAX_FALSE_REJECTION,
                            delta: float = DELTA) -> DataFrame:
    """``lang, rule, cutoff`` of every rule and stratum that can be proved.

    The holdout is every labelled row, counted on the executors: for each
    stratum, rule and grid point the good texts (quality 1) above it. A cutoff
    is proved if at most that many rejections among as many good texts would
    have a probability of ``delta / tests`` or less at a rejection rate of
    ``alpha`` (the exact binomial bound). ``tests`` counts all strata, rules
    and grid points. Rows without a quality label don't count; a doc_id that
    is labelled twice counts twice.
    """
    marks = labels.where(F.col("quality").isNotNull()).select("doc_id", "quality")
    held = signals.select("doc_id", "lang", rule_values().alias("v")).join(marks, "doc_id")
    # one count per stratum, rule and cell of the grid; texts above a point are then sums over cells
    cell = F.size(F.filter(F.array(*map(F.lit, GRID)), lambda g: g < F.col("x")))
    cells = held.select("lang", "quality", F.posexplode("v").alias("rule", "x")).groupBy("lang", "rule", cell.alias("cell")).agg(
        F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    # a rule in a stratum has len(GRID) + 1 cells at most
    rules = cells.groupBy("lang", "rule").agg(F.collect_list(F.struct("cell", "good", "bad")).alias("cells"))
    strata = cells.agg(F.count_distinct(F.struct("lang")).alias("strata")).first()["strata"]
    chosen = rules.withColumn("cutoff", F.pandas_udf(
        lambda cells: pd.Series([best_cutoff(c, strata, alpha, delta) for c in cells], dtype=float), "double")("cells"))
    return chosen.where(F.col("cutoff").isNotNull() & ~F.isnan("cutoff")).select("lang", "rule", "cutoff")


def best_cutoff(cells: list[dict], strata: int, alpha: float, delta: float) -> float | None:
    """The proved cutoff that rejects most bad texts beyond the good ones it
    rejects, the highest of equal ones; None if no proved one rejects more bad
    than good."""
    good, bad = np.zeros(len(GRID) + 1, dtype=np.int64), np.zeros(len(GRID) + 1, dtype=np.int64)
    for c in cells:
        good[c["cell"]], bad[c["cell"]] = c["good"], c["bad"]
    tests, n = strata * len(RULES) * len(GRID), int(good.sum())
    best, chosen = 1, None
    for i, cutoff in reversed(list(enumerate(GRID))):  # a text in cell c is above the first c points
        rejected, gain = int(good[i + 1:].sum()), int(bad[i + 1:].sum())
        if gain - rejected > best - (chosen is None) and binomial_tail(rejected, n, alpha) <= delta / tests:
            best, chosen = gain - rejected, cutoff
    return chosen


def judge_quality(docs: DataFrame, labels: DataFrame, alpha: float = MAX_FALSE_REJECTION, delta: float = DELTA) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``n_rules_broken`` and ``kept``.

    Reads ``doc_id, lang, text`` of the documents and ``doc_id, quality`` of
    the labels; other columns are ignored. A null lang is a stratum of its
    own. Without labels only the base rule rejects. Repeated rows are judged
    alike; an empty table gives no rows.
    """
    from tessera.session import cut_lineage

    signals = cut_lineage(quality_signals(docs))  # read for the holdout and for the verdicts
    cutoffs = risk_controlled_cutoffs(signals, labels, alpha, delta)
    per_stratum = cutoffs.groupBy(F.col("lang").alias("_lang")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut"))  # len(RULES) entries at most
    judged = signals.join(per_stratum, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    above = F.filter(F.transform(rule_values(), lambda x, i: F.coalesce(x > F.try_element_at(F.col("cut"), i), F.lit(False))), lambda b: b)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed).withColumn("n_rules_broken", F.size(above).cast("long"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "n_rules_broken", (~F.col("base_failed") & (F.col("n_rules_broken") == 0)).alias("kept"))
