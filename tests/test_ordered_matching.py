import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators import ordered_matching as M


def plain(rows, limit):
    """Treated rows from the largest score down, nearest control left, lower score on ties."""
    left = sorted((s, i) for i, arm, s in rows if arm == 0)
    out = set()
    for i, _, s in sorted((r for r in rows if r[1] == 1), key=lambda r: (-r[2], r[0])):
        best = min(left, key=lambda c: (abs(c[0] - s), c[0], c[1]), default=None)
        if best and abs(best[0] - s) <= limit:
            left.remove(best)
            out.add((i, best[1]))
    return out


def sample(n, seed, kind):
    rng = random.Random(seed)
    score = {
        "smooth": lambda: rng.randrange(64 * n) / (64 * n),
        "coarse": lambda: rng.randrange(12) / 16,
        "hot": lambda: 0.5 if rng.random() < 0.4 else rng.randrange(64 * n) / (64 * n),
        "gaps": lambda: rng.randrange(5) + rng.randrange(32) / 1024,
    }[kind]
    share = {"smooth": 0.45, "coarse": 0.6, "hot": 0.3, "gaps": 0.5}[kind]
    return [(i, int(rng.random() < share), score()) for i in range(n)]


@pytest.mark.parametrize("kind,block", [("smooth", 40), ("coarse", 30), ("hot", 60), ("gaps", 10**6)])
def test_equals_the_sequential_order(spark, monkeypatch, kind, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rows = sample(160, len(kind) + block % 7, kind)
    df = spark.createDataFrame(rows, "id long, arm int, s double").repartition(3)
    sd = df.agg(F.stddev_samp("s")).first()[0]
    got = M.match_in_order(df, "id", "arm", "s", 0.2).collect()
    assert {(r.treated, r.control) for r in got} == plain(rows, 0.2 * sd)
    assert len(got) == len({r.treated for r in got}) == len({r.control for r in got})


def test_a_long_chain_needs_few_rounds(spark, monkeypatch):
    """Ever-growing gaps, treated and control in turn: mutual nearest rounds would settle one pair each."""
    monkeypatch.setattr(M, "BLOCK", 300)
    calls = []
    one = M._round
    monkeypatch.setattr(M, "_round", lambda *a: calls.append(1) or one(*a))
    scores, at = [], 0.0
    for k in range(1000):
        at += 1 + k / 1000
        scores.append(at)
    rows = [(k, k % 2, s) for k, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "id long, arm int, s double")
    sd = df.agg(F.stddev_samp("s")).first()[0]
    got = {(r.treated, r.control) for r in M.match_in_order(df, "id", "arm", "s", 0.1).collect()}
    assert got == plain(rows, 0.1 * sd) and len(got) > 400 and len(calls) < 15


def test_windows_hold_few_controls():
    """Few treated rows on a dense line of controls: blocks look at what they could use, not at the whole caliper."""
    import numpy as np
    import pandas as pd

    blocks = pd.DataFrame({"block": [0, 1], "lo": [0.8, 0.2], "hi": [0.8, 0.21], "t": [3, 5], "below": [800, 200], "upto": [801, 212]})
    window = M._Windows(blocks, 1.0)
    score, upto = np.arange(1000) / 1000, np.arange(1, 1001)
    first, last = window.of(score, upto, np.ones(1000, int))
    held = [int(((first <= k) & (last > k)).sum()) for k in (0, 1)]
    assert held == [1 + 2 * 3, 12 + 2 * 5]
    near = M._Windows(blocks, 0.002)
    first, last = near.of(score, upto, np.ones(1000, int))
    assert [int(((first <= k) & (last > k)).sum()) for k in (0, 1)] == [5, 15]


def test_nothing_to_match(spark):
    for rows in ([(1, 1, 0.1), (2, 1, 0.2)], [(1, 0, 0.1)], [(1, None, 0.1), (None, 1, 0.2)]):
        df = spark.createDataFrame(rows, "id long, arm int, s double")
        assert M.match_in_order(df, "id", "arm", "s").count() == 0
