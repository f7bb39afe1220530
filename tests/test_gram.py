"""Rank correlations and joint counts of all column pairs against plain Python, missing values included."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest

from tallyward.operators import gram as G

COLS = ["a", "b", "c", "d", "k", "none"]


def rows(seed, n=90):
    rng = random.Random(seed)
    maybe = lambda v, share: None if rng.random() < share else v
    return [
        (float(x := rng.randrange(12)), maybe(x + rng.random(), 0.3), maybe(float(rng.randrange(4)), 0.2), -float(x) * 2, 1.0, None) for _ in range(n)
    ]


def ranks(values):
    return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]


def rho(pairs):
    x, y = ranks([p[0] for p in pairs]), ranks([p[1] for p in pairs])
    mid = (len(pairs) + 1) / 2
    sxy = sum((a - mid) * (b - mid) for a, b in zip(x, y))
    sxx, syy = sum((a - mid) ** 2 for a in x), sum((b - mid) ** 2 for b in y)
    return sxy / math.sqrt(sxx * syy) if sxx and syy else None


def test_spearman_ranks_the_complete_rows_of_each_pair(spark):
    data = rows(3)
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in COLS)).repartition(4)
    got = {(r.var1, r.var2): r.rho for r in G.spearman(df, COLS).collect()}
    want = {}
    for (i, x), (j, y) in combinations(enumerate(COLS), 2):
        pairs = [(r[i], r[j]) for r in data if r[i] is not None and r[j] is not None]
        if pairs:
            want[x, y] = rho(pairs)
    assert set(got) == set(want) and ("a", "none") not in got
    for key, value in want.items():
        assert got[key] == (pytest.approx(value) if value is not None else None)
    assert got["a", "d"] == pytest.approx(-1) and got["a", "k"] is None


def test_no_row_per_pair(spark):
    df = spark.createDataFrame(rows(4), ", ".join(f"{c} double" for c in COLS))
    assert "Generate" not in G.spearman(df, COLS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in G.pair_counts(df, COLS)._jdf.queryExecution().optimizedPlan().toString()


def test_joint_counts_and_cramers_v(spark):
    data = [tuple(None if v is None else str(int(v)) for v in r[:5]) for r in rows(5)]
    cols = COLS[:5]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)).repartition(3)
    want = Counter()
    for (i, x), (j, y) in combinations(enumerate(cols), 2):
        want.update((x, y, r[i], r[j]) for r in data if r[i] is not None and r[j] is not None)
    assert {(r.var1, r.var2, r.a, r.b): r.n for r in G.pair_counts(df, cols).collect()} == want
    got = {(r.var1, r.var2): r.v for r in G.cramers_v(df, cols).collect()}
    assert got["a", "d"] == pytest.approx(1) and got["a", "k"] is None and 0 <= got["a", "c"] < 0.6
