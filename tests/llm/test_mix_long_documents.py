"""The fit of a budget where documents are longer than the programme's least range."""

import itertools
import random

import numpy as np

from tessera.llm import mixing


def best_sum(lengths, counts, budget):
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= budget}
    return max(sums)


def fitted(lengths, counts, budget):
    lengths, counts = np.array(lengths), np.array(counts)
    take = mixing.fit_counts(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    return int((lengths * take).sum())


def test_two_of_each_meet_the_budget():
    assert fitted([25_000, 30_000], [2, 2], 50_000) == 50_000


def test_every_budget_that_a_subset_meets():
    r = random.Random(4)
    for _ in range(150):
        lengths = r.sample(range(1, 60_000), r.randint(1, 5))
        counts = [r.randint(1, 3) for _ in lengths]
        reach = max(mixing.DP_BUDGET, mixing.DP_LONGEST * max(lengths))
        budget = r.randint(1, reach)
        assert fitted(lengths, counts, budget) == best_sum(lengths, counts, budget)


def test_beyond_the_range_the_gap_stays_small():
    r = random.Random(5)
    for _ in range(30):
        lengths = r.sample(range(1, 3000), 60) + r.sample(range(30_000, 90_000), 4)
        counts = [r.randint(1, 400) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts))
        budget = r.randint(total // 10, total - 1)
        assert budget - fitted(lengths, counts, budget) <= min(lengths)


def test_ends():
    for lengths, counts, budget in itertools.product(([7], [7, 30_000]), ([0], [3]), (0, -5, 10**9)):
        counts = counts * len(lengths)
        want = 0 if budget <= 0 else sum(n * c for n, c in zip(lengths, counts))
        assert fitted(lengths, counts, budget) == want
