import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators import matching as M


def greedy(rows, limit):
    """All pairs by (distance, lower score), ids of equal score and arm in order."""
    pools = {}
    for i, arm, s in sorted(rows):
        pools.setdefault((s, arm), []).append(i)
    scores_t = sorted({s for s, a in pools if a == 1})
    scores_c = sorted({s for s, a in pools if a == 0})
    pairs = sorted((abs(t - c), min(t, c), t, c) for t in scores_t for c in scores_c if abs(t - c) <= limit)
    out = set()
    for _, _, t, c in pairs:
        a, b = pools[(t, 1)], pools[(c, 0)]
        m = min(len(a), len(b))
        out |= set(zip(a[:m], b[:m]))
        del a[:m], b[:m]
    return out


def sample(n, seed, hot=0.0):
    rng = random.Random(seed)
    return [
        (i, int(rng.random() < 0.4), 0.5 if rng.random() < hot else rng.randrange(64 * n) / (64 * n))
        for i in range(n)
    ]


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_rounds_equal_brute_force(spark, hot):
    rows = sample(150, 11, hot)
    df = spark.createDataFrame(rows, "id long, arm int, s double")
    sd = df.agg(F.stddev_samp("s")).first()[0]
    got = M.match_pairs(df, "id", "arm", "s", 0.1).collect()
    assert {(r.treated, r.control) for r in got} == greedy(rows, 0.1 * sd)
    assert all(r.distance <= 0.1 * sd for r in got)
    assert len({r.treated for r in got}) == len({r.control for r in got}) == len(got)


def test_large_run_expands_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 7)
    df = spark.range(100).select("id", (F.col("id") % 2).cast("int").alias("arm"), F.lit(0.3).alias("s"))
    pairs = M.match_pairs(df, "id", "arm", "s")
    got = {(r.treated, r.control) for r in pairs.collect()}
    assert got == {(2 * k + 1, 2 * k) for k in range(50)}
    counts = {r.arm: (r.n_before, r.n_after) for r in M.match_counts(df, "arm", pairs).collect()}
    assert counts == {0: (50, 50), 1: (50, 50)}
    assert M.matched_rows(df, "id", pairs).count() == 100


def test_nothing_to_match(spark):
    df = spark.createDataFrame([(1, 1, 0.1), (2, 1, 0.2)], "id long, arm int, s double")
    assert M.match_pairs(df, "id", "arm", "s").count() == 0
