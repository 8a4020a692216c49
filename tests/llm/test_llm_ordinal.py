"""The ordinal fit against a slow likelihood."""

import math
from dataclasses import replace

import numpy as np

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import toxicity


def loss(rows, grades, w, t, l2):
    """Mean negative log-likelihood of the cumulative links, one document
    and one threshold at a time, and the penalty of the weights."""
    def below(k, z):
        return 1.0 if k >= len(t) else 0.0 if k < 0 else 1 / (1 + math.exp(-(t[k] - z)))

    total = 0.0
    for r, y in zip(rows, grades):
        z = sum(w.get(int(c), 0.0) for c in r)
        total -= math.log(max(below(y, z) - below(y - 1, z), 1e-12))
    return total / len(rows) + l2 * sum(x * x for x in w.values()) / (2 * max(1, len(w)))


def test_fit_is_a_minimum_of_the_slow_likelihood():
    rng = np.random.default_rng(4)
    p = replace(toxicity.Ordinal(), bits=10, steps=4000, rate=0.01, min_docs=5)
    true = np.zeros(1024)
    true[:6] = [2.0, 1.5, 1.0, -1.0, -1.5, 0.8]
    rows, grades = [], []
    for _ in range(500):
        r = np.unique(np.concatenate([np.flatnonzero(rng.random(6) < 0.3), rng.integers(6, 60, 8)]))
        rows.append(r)
        grades.append(int(np.searchsorted([0.5, 2.0], true[r].sum() + rng.logistic())))
    w, t = toxicity.fit(rows, grades, 3, p)
    t = list(t)
    assert w and t[0] < t[1]
    at = loss(rows, grades, w, t, p.l2)
    assert at < loss(rows, grades, {}, t, p.l2)
    for c in w:
        for step in (0.1, -0.1):
            assert loss(rows, grades, {**w, c: w[c] + step}, t, p.l2) > at - 1e-4
    for k in range(2):
        for step in (0.1, -0.1):
            moved = [x + step * (i == k) for i, x in enumerate(t)]
            assert loss(rows, grades, w, moved, p.l2) > at - 1e-4
