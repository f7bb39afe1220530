import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import bootstrap as B
from tallyward.operators import causal as C
from tallyward.operators import design as X


@pytest.fixture(scope="module")
def trial(spark):
    n = F.col("id")
    df = spark.range(2000).select(
        n.alias("id"),
        (n % 7).cast("double").alias("x"),
        F.when(n % 3 == 0, "u").otherwise("v").alias("c"),
        ((n * 37 % 101) < 30 + 5 * (n % 7)).cast("int").alias("a"),
    )
    return df.withColumn("y", ((F.col("id") * 53 % 97) < 20 + 15 * F.col("a") + 3 * F.col("x")).cast("int"))


def test_closed_form_odds_ratio_is_the_regression(trial):
    row = C.weighted_odds_ratio(trial, "a", "y").first()
    table = {r.term: r for r in C.coefficient_table(C.fit_logit(trial, "y", ["a"])).collect()}
    assert math.log(row.odds_ratio) == pytest.approx(table["a"].estimate, rel=1e-6)
    # with unit weights the dispersion is n / (n - 2)
    assert row.std_error == pytest.approx(table["a"].std_error * math.sqrt(2000 / 1998), rel=1e-5)


def test_treatment_coding_uses_first_level(trial):
    terms = {r.term for r in C.coefficient_table(C.fit_logit(trial, "y", ["a", "c"])).collect()}
    assert terms == {"a", "c_v", "(Intercept)"}


def test_weights_balance_the_covariate(trial):
    w = C.stabilised_weights(C.propensity(trial, "a", ["x", "c"]), "a", "ps")
    rows = {r.covariate: r for r in C.balance(w, "a", ["x"], {"c": ["u", "v"]}, "iptw").collect()}
    assert abs(rows["x"].smd_weighted) < 0.02 < abs(rows["x"].smd)
    assert rows["x"].balanced
    assert rows["c_u"].smd == pytest.approx(-rows["c_v"].smd)
    ess = {r.a: r for r in C.weight_summary(w, "a", "iptw").collect()}
    assert ess[1].ess <= ess[1].n and ess[0].ess <= ess[0].n


def test_aipw_with_constant_outcome_model_is_ipw(trial):
    df = C.propensity(trial, "a", ["x"]).withColumns({"m1": F.lit(0.0), "m0": F.lit(0.0)})
    row = C.aipw(df, "a", "y", "ps", "m1", "m0").first()
    want = df.agg(F.avg(F.col("a") * F.col("y") / F.col("ps"))).first()[0]
    assert row.mean_1 == pytest.approx(want)
    assert row.risk_difference == pytest.approx(row.mean_1 - row.mean_0)


def test_bootstrap_agrees_with_point_estimate(trial):
    point = C.fit_aipw(trial, "a", "y", ["x", "c"])
    reps = B.bootstrap_aipw(trial, "id", "a", "y", ["x", "c"], reps=60)
    again = B.bootstrap_aipw(trial.repartition(9), "id", "a", "y", ["x", "c"], reps=60)
    a = [r[1] for r in reps.orderBy("rep").collect()]
    assert len(a) == 60
    assert a == pytest.approx([r[1] for r in again.orderBy("rep").collect()], rel=1e-6)
    row = B.normal_interval(point, reps).first()
    assert row.low < row.estimate < row.high
    assert np.mean(a) == pytest.approx(row.estimate, abs=3 * row.std_error)


def test_poisson_counts_have_mean_and_variance_one():
    c = B.poisson_counts(np.arange(20_000), 20, 1)
    assert c.mean() == pytest.approx(1.0, abs=0.01)
    assert c.var() == pytest.approx(1.0, abs=0.02)


def test_sample_size_published_example(spark):
    seg = spark.createDataFrame([("all", 0.112)], "segment string, risk double")
    rows = {r.arr: r.n_per_arm for r in X.sample_size(seg, "risk", [0.03, 0.04], [0.05], [0.8]).collect()}
    assert rows == {0.03: 1520, 0.04: 811}
    at = X.power_curve(seg, "risk", [0.03], (1520, 1520, 10)).first()
    assert at.power == pytest.approx(0.8, abs=5e-4)
    plan = X.feasibility(X.sample_size(seg.withColumn("pct", F.lit(0.157)), "risk", [0.03], [0.05], [0.8]), "pct", 5000).first()
    assert (plan.annual_flagged, plan.annual_per_arm, plan.years_required) == (785, 392, 3.9)


def test_blocks_are_even_in_every_stratum(spark):
    df = spark.range(403).select("id", (F.col("id") % 2).alias("s"))
    out = X.block_randomize(df, "id", ["s"], 4)
    full = out.groupBy("s", "block").agg(F.count("*").alias("n"), F.sum("arm").alias("t")).where("n = 4")
    assert full.where("t <> 2").count() == 0
    assert out.count() == 403


def test_analyses_summary(spark, trial):
    rows = C.summarize_analyses([
        ("first", "ATE", "weighting", "odds ratio", C.weighted_odds_ratio(trial, "a", "y"), "odds_ratio"),
        ("second", "ATE", "doubly robust", "risk difference", C.fit_aipw(trial, "a", "y", ["x"]), "risk_difference"),
    ]).collect()
    assert [r.analysis for r in rows] == ["first", "second"]
    assert all(r.estimate is not None for r in rows)
