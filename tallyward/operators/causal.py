"""Treatment effects: propensity weighting, balance, doubly robust estimates.

Fits go through Spark ML; everything that has a closed form is one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.stats import e_value, t_two_sided
from tallyward.operators.features import category_levels, sql_text
from tallyward.operators.ordered import running_totals
from tallyward.operators.profile import to_long
from tallyward.session import materialize

TERM = "__t_"  # keeps design columns apart from the table's own
SMD_LIMIT = 0.1
Z_95 = 1.959963984540054  # fixed value: 97.5 % point of the standard normal


def design(df: DataFrame, covariates: Sequence[str], interactions: Sequence[str] = ()) -> dict[str, str]:
    """Treatment-coded terms as SQL expressions, in formula order.

    Strings get one 0/1 term per level but the alphabetically first, found in
    one pass for all columns; a level unseen here reads as the baseline. A
    NULL stays NULL in its terms. ``interactions`` name products: ``a:b``.
    """
    types = dict(df.dtypes)
    parts = {c for term in interactions for c in term.split(":")}
    used = list(dict.fromkeys([*covariates, *sorted(parts)]))
    text = [c for c in used if types[c] in ("string", "boolean")]
    levels = category_levels(df, text) if text else {}

    def terms(c: str) -> dict[str, str]:
        if c not in levels:
            return {c: f"CAST(`{c}` AS DOUBLE)"}
        return {
            f"{c}_{v}": f"CAST(CAST(`{c}` AS STRING) = {sql_text(v)} AS DOUBLE)" for v in levels[c][1:]
        }

    out: dict[str, str] = {}
    for c in covariates:
        out.update(terms(c))
    for term in interactions:
        crossed = {"": "1.0D"}
        for c in term.split(":"):
            crossed = {
                (f"{n}:{m}" if n else m): f"{e} * {g}" for n, e in crossed.items() for m, g in terms(c).items()
            }
        out.update(crossed)
    return out


def design_stages(terms: dict[str, str], out: str = "__x") -> list:
    """Native ML stages assembling the terms; rows with a NULL term are left out."""
    select = ", ".join(f"{e} AS `{n}`" for n, e in _prefixed(terms).items())
    names = list(_prefixed(terms))
    return [
        SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=out, handleInvalid="skip"),
        SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{n}`' for n in names)}) FROM __THIS__"),
    ]


def _prefixed(terms: dict[str, str]) -> dict[str, str]:
    return {f"{TERM}{n}": e for n, e in terms.items()}


def fit_logit(
    df: DataFrame,
    response: str,
    covariates: Sequence[str],
    interactions: Sequence[str] = (),
    weight: str | None = None,
    output: str = "fitted",
) -> PipelineModel:
    """Logistic GLM with treatment-coded categories.

    The design is written once in the shared folder: every reweighting step
    of the fit reads the matrix, not the plan behind it.
    """
    stages = PipelineModel(design_stages(design(df, covariates, interactions)))
    keep = [F.col(response).cast("double").alias("__y"), "__x", *([weight] if weight else [])]
    matrix = materialize(stages.transform(df.where(F.col(response).isNotNull())).select(*keep), "design")
    glm = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="__x", labelCol="__y", predictionCol=output, maxIter=25
    )
    if weight:
        glm = glm.setWeightCol(weight)
    return PipelineModel([*stages.stages, glm.fit(matrix)])


def fit_state(model: PipelineModel) -> DataFrame:
    """(iterations, converged, deviance) of a fitted GLM; under perfect separation the steps run out."""
    glm = model.stages[-1]
    summary = glm.summary
    row = (summary.numIterations, summary.numIterations < glm.getMaxIter(), float(summary.deviance))
    return summary.predictions.sparkSession.createDataFrame([row], "iterations int, converged boolean, deviance double")


def propensity(df: DataFrame, treatment: str, covariates: Sequence[str], out: str = "ps") -> DataFrame:
    """Fitted treatment probability on every row."""
    model = fit_logit(df, treatment, covariates, output=out)
    return model.transform(df).drop("__x")


def coefficient_table(model: PipelineModel) -> DataFrame:
    """Term, estimate, standard error, statistic and p-value; a row per term."""
    glm = model.stages[-1]
    summary = glm.summary
    assembler = model.stages[-3]
    terms = [n.removeprefix(TERM) for n in assembler.getInputCols()] + ["(Intercept)"]
    # the summary orders terms as features first, intercept last
    values = list(glm.coefficients) + [glm.intercept]
    rows = [
        (t, float(v), float(se), float(z), float(p))
        for t, v, se, z, p in zip(
            terms, values, summary.coefficientStandardErrors, summary.tValues, summary.pValues
        )
    ]
    session = summary.predictions.sparkSession
    return session.createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")


def stabilised_weights(df: DataFrame, treatment: str, ps: str, out: str = "iptw") -> DataFrame:
    """ATE weights P(A) / ps for treated and P(not A) / (1 - ps) for control rows."""
    rate = df.agg(F.avg(treatment)).scalar()
    a, p = F.col(treatment), F.col(ps)
    return (
        df.withColumn("__rate", rate)
        .withColumn(out, F.when(a == 1, F.col("__rate") / p).otherwise((1 - F.col("__rate")) / (1 - p)))
        .drop("__rate")
    )


def weight_summary(df: DataFrame, treatment: str, weight: str) -> DataFrame:
    """Size, weight range and effective sample size per arm."""
    w = F.col(weight)
    return df.groupBy(treatment).agg(
        F.count("*").alias("n"),
        F.min(w).alias("min_weight"),
        F.max(w).alias("max_weight"),
        (F.sum(w) * F.sum(w) / F.sum(w * w)).alias("ess"),
    )


def balance(
    df: DataFrame,
    treatment: str,
    numeric: Sequence[str],
    categorical: dict[str, Sequence[str]] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Standardised mean difference and KS distance per covariate, raw and weighted.

    Numeric differences are divided by the pooled unweighted sd; levels of a
    category give the plain difference in proportion. One ordering of the
    distinct (covariate, value) pairs yields all four figures.
    """
    dummies = {
        f"{c}_{level}": (F.col(c) == level).cast("double")
        for c, levels in (categorical or {}).items()
        for level in levels
    }
    w = F.col(weight) if weight else F.lit(1.0)
    slim = df.where(F.col(treatment).isNotNull()).select(
        F.col(treatment).alias("__a"),
        w.cast("double").alias("__w"),
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *[e.alias(n) for n, e in dummies.items()],
    )
    long = to_long(slim, ["__a", "__w"], [*numeric, *dummies], "double")
    treated, control = F.col("__a") == 1, F.col("__a") == 0
    zero = F.lit(0.0)
    measures = {
        "n1": F.count_if(treated),
        "n0": F.count_if(control),
        "w1": F.sum(F.when(treated, F.col("__w")).otherwise(zero)),
        "w0": F.sum(F.when(control, F.col("__w")).otherwise(zero)),
    }
    cum = running_totals(long, "value", measures, ["variable"])
    sizes = long.groupBy("variable").agg(*[e.alias(f"t_{n}") for n, e in measures.items()])
    joined = cum.join(sizes, "variable")
    v = F.col("value")

    def mean(n: str) -> Column:
        return F.sum(v * F.col(n)) / F.max(f"t_{n}")

    def variance(n: str) -> Column:
        t = F.max(f"t_{n}")
        return (F.sum(v * v * F.col(n)) - F.sum(v * F.col(n)) * F.sum(v * F.col(n)) / t) / (t - 1)

    def gap(one: str, zero_: str) -> Column:
        return F.max(F.abs(F.col(f"cum_{one}") / F.col(f"t_{one}") - F.col(f"cum_{zero_}") / F.col(f"t_{zero_}")))

    stats = joined.groupBy("variable").agg(
        (mean("n1") - mean("n0")).alias("diff"),
        (mean("w1") - mean("w0")).alias("diff_w"),
        F.sqrt((variance("n1") + variance("n0")) / 2).alias("sd"),
        gap("n1", "n0").alias("ks"),
        gap("w1", "w0").alias("ks_weighted"),
    )
    scale = F.when(F.col("variable").isin(*dummies), F.lit(1.0)).otherwise(F.col("sd")) if dummies else F.col("sd")
    smd, smd_w = F.col("diff") / scale, F.col("diff_w") / scale
    return stats.select(
        F.col("variable").alias("covariate"),
        F.when(scale > 0, smd).alias("smd"),
        F.when(scale > 0, smd_w).alias("smd_weighted"),
        "ks",
        "ks_weighted",
        (F.abs(F.when(scale > 0, smd_w)) <= SMD_LIMIT).alias("balanced"),
    )


def weighted_odds_ratio(df: DataFrame, treatment: str, outcome: str, weight: str | None = None) -> DataFrame:
    """Odds ratio of a binary treatment under weights, closed form.

    Equals the weighted quasi-binomial regression on the treatment alone:
    standard error with dispersion (W1 + W0) / (n - 2), t with n - 2 degrees
    of freedom, Wald interval. One aggregate over the rows.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    a, y = F.col(treatment), F.col(outcome)
    s = df.dropna(subset=[treatment, outcome, *([weight] if weight else [])]).agg(
        F.count("*").alias("n"),
        F.sum(F.when(a == 1, w).otherwise(0.0)).alias("w1"),
        F.sum(F.when(a == 0, w).otherwise(0.0)).alias("w0"),
        F.sum(F.when(a == 1, w * y).otherwise(0.0)).alias("y1"),
        F.sum(F.when(a == 0, w * y).otherwise(0.0)).alias("y0"),
    )
    p1, p0 = F.col("y1") / F.col("w1"), F.col("y0") / F.col("w0")
    odds = s.withColumns({"p1": p1, "p0": p0}).withColumns(
        {
            "log_or": F.log(F.col("p1") / (1 - F.col("p1"))) - F.log(F.col("p0") / (1 - F.col("p0"))),
            "std_error": F.sqrt(
                (F.col("w1") + F.col("w0"))
                / (F.col("n") - 2)
                * (
                    1 / (F.col("w1") * F.col("p1") * (1 - F.col("p1")))
                    + 1 / (F.col("w0") * F.col("p0") * (1 - F.col("p0")))
                )
            ),
        }
    )
    t = F.col("log_or") / F.col("std_error")
    return odds.select(
        "n",
        F.exp("log_or").alias("odds_ratio"),
        "std_error",
        t.alias("statistic"),
        t_two_sided(t, F.col("n") - 2).alias("p_value"),
        F.exp(F.col("log_or") - Z_95 * F.col("std_error")).alias("wald_low"),
        F.exp(F.col("log_or") + Z_95 * F.col("std_error")).alias("wald_high"),
    )


def aipw(df: DataFrame, treatment: str, outcome: str, ps: str, m1: str, m0: str) -> DataFrame:
    """Doubly robust means, risk difference and risk ratio: one aggregate.

    ``m1`` and ``m0`` are outcome predictions under treatment and control.
    """
    a, y, p = F.col(treatment), F.col(outcome), F.col(ps)
    means = df.agg(
        F.avg(F.col(m1) + a / p * (y - F.col(m1))).alias("mean_1"),
        F.avg(F.col(m0) + (1 - a) / (1 - p) * (y - F.col(m0))).alias("mean_0"),
    )
    return means.select(
        "mean_1",
        "mean_0",
        (F.col("mean_1") - F.col("mean_0")).alias("risk_difference"),
        (F.col("mean_1") / F.col("mean_0")).alias("risk_ratio"),
    )


def toggled_predictions(model: PipelineModel, df: DataFrame, treatment: str, out1: str = "m1", out0: str = "m0") -> DataFrame:
    """Every row scored as treated and as control by one fitted model, no join."""
    fitted = model.stages[-1].getPredictionCol()
    extra = ["__x", fitted]
    actual = df.withColumn("__actual", F.col(treatment))
    once = model.transform(actual.withColumn(treatment, F.lit(1))).withColumn(out1, F.col(fitted)).drop(*extra)
    twice = model.transform(once.withColumn(treatment, F.lit(0))).withColumn(out0, F.col(fitted)).drop(*extra)
    return twice.withColumn(treatment, F.col("__actual")).drop("__actual")


def fit_aipw(df: DataFrame, treatment: str, outcome: str, covariates: Sequence[str]) -> DataFrame:
    """Both models fitted on ``df``, then the doubly robust estimate."""
    scored = propensity(df, treatment, covariates)
    outcome_model = fit_logit(df, outcome, [treatment, *covariates])
    return aipw(toggled_predictions(outcome_model, scored, treatment), treatment, outcome, "ps", "m1", "m0")


def with_e_value(df: DataFrame, ratio: str) -> DataFrame:
    return df.withColumn("e_value", e_value(F.col(ratio)))


def summarize_analyses(rows: Sequence[tuple[str, str, str, str, DataFrame, str]]) -> DataFrame:
    """Stack one-row results: (analysis, estimand, method, metric, frame, column)."""
    out = None
    for analysis, estimand, method, metric, frame, col in rows:
        line = frame.select(
            F.lit(analysis).alias("analysis"),
            F.lit(estimand).alias("estimand"),
            F.lit(method).alias("method"),
            F.lit(metric).alias("metric"),
            F.col(col).cast("double").alias("estimate"),
        )
        out = line if out is None else out.unionByName(line)
    return out


def design_array(df: DataFrame, response: str, covariates: Sequence[str], out: str) -> DataFrame:
    """Treatment-coded covariates with an intercept as an array column."""
    terms = design(df, covariates)
    complete = df.where(F.col(response).isNotNull())
    wide = complete.withColumn(out, F.array(F.lit(1.0), *[F.expr(e) for e in terms.values()]))
    return wide.where(~F.exists(out, lambda v: v.isNull()))
