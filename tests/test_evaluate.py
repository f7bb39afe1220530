import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators import drift as D
from tallyward.operators import evaluate as E


def scored(spark, rows):
    return spark.createDataFrame(rows, "g string, s double, y int")


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_metrics_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(40) / 100, int(rng.random() < 0.3)) for _ in range(600)]
    got = {r.g: r for r in E.metric_row(scored(spark, rows), "s", "y", 0.2, ["g"]).collect()}
    for g in "ab":
        pairs = [(s, y) for k, s, y in rows if k == g]
        flagged = [y for s, y in pairs if s >= 0.2]
        pos = sum(y for _, y in pairs)
        assert got[g].auc_roc == pytest.approx(brute_auc(pairs))
        assert got[g].brier == pytest.approx(sum((s - y) ** 2 for s, y in pairs) / len(pairs))
        precision, recall = sum(flagged) / len(flagged), sum(flagged) / pos
        assert got[g].flagged_n == len(flagged)
        assert got[g].precision_tau == pytest.approx(precision)
        assert got[g].recall_tau == pytest.approx(recall)
        assert got[g].f1_tau == pytest.approx(2 * precision * recall / (precision + recall))
        ap, seen = 0.0, 0.0
        for cut in sorted({s for s, _ in pairs}, reverse=True):
            top = [y for s, y in pairs if s >= cut]
            ap += (sum(top) / pos - seen) * sum(top) / len(top)
            seen = sum(top) / pos
        assert got[g].auc_pr == pytest.approx(ap)


def test_auc_ties_one_class_and_symmetry(spark):
    rows = [("tie", 0.5, 1), ("tie", 0.5, 0), ("one", 0.2, 1), ("one", 0.4, 1), ("ok", 0.1, 0), ("ok", 0.9, 1), ("ok", 0.3, 1), ("ok", 0.5, 0)]
    got = {r.g: r.auc_roc for r in E.auc(scored(spark, rows), "s", "y", ["g"]).collect()}
    assert got == {"tie": 0.5, "one": None, "ok": 0.75}
    flipped = scored(spark, rows).withColumn("s", 1 - F.col("s"))
    assert {r.g: r.auc_roc for r in E.auc(flipped, "s", "y", ["g"]).collect()}["ok"] == pytest.approx(0.25)


def test_nothing_flagged_gives_zero(spark):
    row = E.metric_row(scored(spark, [("a", 0.1, 1), ("a", 0.2, 0)]), "s", "y", 0.9).first()
    assert (row.flagged_n, row.precision_tau, row.recall_tau, row.f1_tau, row.flagged_pos_rate) == (0, 0.0, 0.0, 0.0, 0.0)


def test_sweep_equals_single_thresholds(spark):
    rng = random.Random(8)
    df = scored(spark, [("a", rng.randrange(30) / 100, int(rng.random() < 0.4)) for _ in range(300)])
    taus = [0.0, 0.05, 0.1, 0.29, 0.5]
    sweep = {r.tau: r for r in E.threshold_sweep(df, "s", "y", taus).collect()}
    assert sorted(sweep) == taus
    for tau in taus:
        single = E.threshold_metrics(df, "s", "y", tau).first()
        assert sweep[tau].flagged_n == single.flagged_n
        assert sweep[tau].precision_tau == pytest.approx(single.precision_tau)


def test_curves_reach_their_ends(spark):
    df = scored(spark, [("a", 0.9, 1), ("a", 0.5, 0), ("a", 0.5, 1), ("a", 0.1, 0), ("one", 0.3, 1)])
    roc = {(r.threshold, r.fpr, r.tpr) for r in E.roc_points(df, "s", "y", ["g"]).where("g = 'a'").collect()}
    assert roc == {(None, 0.0, 0.0), (0.9, 0.0, 0.5), (0.5, 0.5, 1.0), (0.1, 1.0, 1.0)}
    pr = E.pr_points(df.where("g = 'a'"), "s", "y").collect()
    assert {(r.threshold, r.precision, r.recall) for r in pr} == {(None, 1.0, 0.0), (0.9, 1.0, 0.5), (0.5, 2 / 3, 1.0), (0.1, 0.5, 1.0)}
    assert E.roc_points(df, "s", "y", ["g"]).where("g = 'one'").isEmpty()


def test_reliability_bins_are_right_closed(spark):
    df = scored(spark, [("a", 0.0, 0), ("a", 0.1, 1), ("a", 0.1000001, 1), ("a", 1.0, 1)])
    assert {r.bin: r.n for r in E.reliability(df, "s", "y").collect()} == {0: 2, 1: 1, 9: 1}


def test_subgroup_floor_and_nulls(spark):
    rows = [("small", 0.5, 1)] * 49 + [("big", 0.5, 1)] * 25 + [("big", 0.05, 0)] * 25 + [("pos", 0.01, 1)] * 50 + [(None, 0.5, 1)] * 60
    got = {r.level: r for r in E.subgroup_metrics(scored(spark, rows), "s", "y", 0.12, ["g"]).collect()}
    assert set(got) == {"big", "pos"}
    assert got["big"].auc_roc == 1.0
    assert (got["pos"].auc_roc, got["pos"].precision_tau, got["pos"].recall_tau) == (None, None, 0.0)


def test_rank_lookup_and_directions(spark):
    df = spark.createDataFrame([("m1", "a", 3.0), ("m1", "b", 1.0), ("m2", "b", 9.0)], "model string, feature string, value double")
    ranked = E.rank_features(df, "model", "feature", "value")
    got = {r.feature: (r.rank_m1, r.rank_m2) for r in E.compare_ranks(ranked, "model", "feature", ["m1", "m2"], "m1", 10, 75).collect()}
    assert got == {"a": (1, 75), "b": (2, 1)}
    expected = spark.createDataFrame([("a", 1), ("b", -1), ("c", 1), ("z", 1)], "feature string, expected_sign int")
    coefs = spark.createDataFrame([("a", 0.3), ("b", 0.2), ("z", 0.0)], "feature string, coefficient double")
    got = {r.feature: r.consistent for r in E.direction_check(expected, coefs, "feature").collect()}
    assert got == {"a": "yes", "b": "no", "c": "zeroed", "z": "zeroed"}


def values(spark, vals, **cols):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in vals], "v double")
    return df.withColumns({k: F.lit(v) for k, v in cols.items()})


def psi_of(spark, ref, cur):
    fitted = D.fit_psi_reference(values(spark, ref), ["v"])
    return D.psi(fitted, values(spark, cur, p=1), "p").first()


def test_psi_of_itself_is_zero(spark):
    row = psi_of(spark, range(100), range(100))
    assert row.psi == pytest.approx(0.0) and not row.degenerate


def test_psi_degenerate_reference(spark):
    row = psi_of(spark, [0] * 99 + [1], range(50))
    assert (row.psi, row.degenerate) == (0.0, True)


def test_psi_leaves_out_of_range_values_out(spark):
    inside = psi_of(spark, range(100), range(50))
    padded = psi_of(spark, range(100), list(range(50)) + [-5, 1000, None])
    assert padded.psi == pytest.approx(inside.psi)
    assert psi_of(spark, range(100), [500, 600]).psi is None


def test_psi_floors_empty_bins(spark):
    import math

    ref, cur = list(range(100)), list(range(50))
    want = sum((a - 0.1) * math.log(a / 0.1) for a in [0.2] * 5 + [1e-4] * 5)
    got = psi_of(spark, ref, cur).psi
    assert got == pytest.approx(want, abs=0.02)  # edges at 9.9, 19.8, ... share the fifty values almost evenly


def test_ks_zero_and_symmetric(spark):
    a, b = values(spark, range(40), p=1), values(spark, range(10, 60), p=1)
    same = D.ks_by_period(a, a, "v", "p", [1]).first()
    assert same.ks_stat == 0.0 and same.ks_pval == 1.0
    ab, ba = D.ks_by_period(a, b, "v", "p", [1]).first(), D.ks_by_period(b, a, "v", "p", [1]).first()
    assert ab.ks_stat == pytest.approx(ba.ks_stat) == pytest.approx(0.4)


def test_report_rounding_and_alerts(spark):
    ref = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 100).cast("double").alias("f"), (F.col("id") % 97 / 100).alias("s"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    cur = ref.withColumn("f", F.col("f") * 0.3).withColumn("k", F.col("k") + 1000)
    rep = D.round_report(D.drift_report(ref, cur, "k", "s", "y", ["f"], 3, 0.12)).orderBy("batch")
    rows = rep.collect()
    assert [r.n_rows for r in rows] == [133, 133, 134]
    assert all(r.drift_alert for r in rows)
    assert D.drift_alerts(rep).first()["psi_flags"] == ["f"]
    assert D.drift_summary(rep).first()["n_alerts"] == 3


def test_models_compared_by_their_scores(spark):
    from tallyward.plans.catalog_evaluate import compare_models

    rows = [("m", "train", 1, 0.9), ("m", "train", 0, 0.1), ("m", "train", 0, 0.2)]
    rows += [("m", "validation", 1, 0.3), ("m", "validation", 0, 0.5), ("m", "validation", 0, 0.05), ("m", "validation", 1, 0.6)]
    got = compare_models(spark.createDataFrame(rows, "model string, split_group string, y int, p double"), 0.12).collect()
    assert [(r.train_auc_roc, r.validation_auc_roc, r.gap, r.validation_recall, r.validation_flagged_rate) for r in got] == [
        (1.0, 0.75, 0.25, 1.0, 0.75)
    ]
