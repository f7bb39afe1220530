"""Classifiers, search, calibration and attribution as Spark ML jobs.

Departures from the boosting and neural libraries this mirrors: Spark grows
trees level by level and has no leaf penalties, and its perceptron has no
dropout, batch norm or class weights, so the positive class is repeated in
proportion instead.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.operators.evaluate import auc
from tallyward.operators.ordered import default_buckets, join_groups, running_totals
from tallyward.operators.profile import with_class_weight
from tallyward.session import cut_lineage
from tallyward.sources.readers import read_if_complete


def logistic(label: str, features: str, c: float, l1_ratio: float, total_weight: float, weight: str = "class_weight") -> LogisticRegression:
    """Elastic-net logistic regression; ``c`` is the inverse penalty per unit weight."""
    return LogisticRegression(
        featuresCol=features,
        labelCol=label,
        weightCol=weight,
        elasticNetParam=l1_ratio,
        regParam=1.0 / (c * total_weight),
        standardization=False,
        maxIter=200,
    )


def boosted_trees(label: str, features: str, weight: str | None = "class_weight", **params) -> GBTClassifier:
    """Gradient-boosted trees; ``params`` are GBTClassifier settings."""
    gbt = GBTClassifier(featuresCol=features, labelCol=label, **params)
    return gbt.setWeightCol(weight) if weight else gbt


def boosted_trees_deep(label: str, features: str, weight: str | None = "class_weight", **params) -> GBTClassifier:
    """Second boosted configuration: deeper trees with a floor on rows per leaf."""
    return boosted_trees(label, features, weight, **{"maxDepth": 7, "minInstancesPerNode": 20, **params})


def perceptron(label: str, features: str, width: int, hidden: Sequence[int] = (128, 64, 32), **params) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=[width, *hidden, 2], **{"maxIter": 100, "seed": 7, **params}
    )


def minority_copies(df: DataFrame, label: str) -> Column:
    """How many rows a row stands for: positives the whole class ratio, others one."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    times = max(1, round(counts["n"] / counts["p"])) if counts["p"] else 1
    return F.when(F.col(label) == 1, F.lit(times)).otherwise(F.lit(1))


def repeat_minority(df: DataFrame, label: str) -> DataFrame:
    """Positive rows repeated by the whole class ratio; no row is dropped."""
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), minority_copies(df, label)))).drop("__copy")


def positive_probability(model: Model, df: DataFrame, out: str = "prob") -> DataFrame:
    """Probability of class 1 on every row, working columns dropped."""
    scored = model.transform(df)
    added = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(*[c for c in added if c != out])


def raw_margin(model: Model, df: DataFrame, out: str = "margin") -> DataFrame:
    """Log odds of class 1, clipped away from infinity."""
    p = F.least(F.greatest(F.col("__p"), F.lit(1e-12)), F.lit(1 - 1e-12))
    return positive_probability(model, df, "__p").withColumn(out, F.log(p / (1 - p))).drop("__p")


def stratified_fold(df: DataFrame, key: str, label: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold by position: rows of a class, in the order of a seeded hash, are dealt to k folds in turn.

    Class sizes differ by one row at most between folds. Rows that repeat a
    key share its fold. The hash is 60 bits of MD5, so other engines can
    repeat the order; the numbering is the two-level one, so a class may hold
    any share of the rows.
    """
    digest = F.md5(F.concat_ws(":", F.col(key), F.lit(seed)))
    hashed = df.withColumn("__h", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    numbered = running_totals(hashed, "__h", {"__one": F.count("*")}, [label]).select(
        label, "__h", ((F.col("cum___one") - F.col("__one")) % k).cast("int").alias(out)
    )
    return join_groups(hashed, numbered, [label], ["__h"]).drop("__h")


# --- search -----------------------------------------------------------------


def random_grid(space: Mapping[str, Sequence], trials: int, seed: int = 0) -> list[dict]:
    """Distinct random parameter combinations, all of them if few exist."""
    names = list(space)
    combos = list(itertools.product(*space.values()))
    random.Random(seed).shuffle(combos)
    return [dict(zip(names, c)) for c in combos[:trials]]


Fit = Callable[[DataFrame], Model]
FitParams = Callable[[dict, DataFrame], Model]
ScoreTogether = Callable[[Sequence[dict], DataFrame], DataFrame | None]
Trials = list[tuple[dict, float]]


def in_parallel(spark: SparkSession, task: Callable, items: Sequence, workers: int) -> list:
    """Results in the order of the items; jobs of several trials share the cluster."""
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


def _held_out_auc(model: Model, held: DataFrame, label: str) -> float:
    value = auc(positive_probability(model, held), "prob", label).first()["auc_roc"]
    return float("nan") if value is None else value


def _best(trials: Trials) -> tuple[dict, float, Trials]:
    params, score = max(trials, key=lambda r: (r[1] == r[1], r[1]))
    return params, score, trials


def search(
    fit: FitParams, grid: Sequence[dict], train: DataFrame, valid: DataFrame, label: str, workers: int = 4
) -> tuple[dict, float, Trials]:
    """Parameters with the best exact validation AUC, its value and every trial's."""
    scores = in_parallel(
        train.sparkSession, lambda params: _held_out_auc(fit(params, train), valid, label), grid, workers
    )
    return _best(list(zip(grid, scores)))


def search_cv(
    fit: FitParams, grid: Sequence[dict], df: DataFrame, fold: str, k: int, label: str, workers: int = 4, together: ScoreTogether | None = None
) -> tuple[dict, float, Trials]:
    """Parameters with the best mean AUC over k held-out folds, its value and every trial's.

    ``fit`` sees the rows of the other folds only, so weights and penalties
    follow from them. A fold with one class leaves its trial without a value.
    ``together`` does the same for all trials at once: held-out rows with
    ``trial``, ``fold`` and ``prob``; where it gives None, ``fit`` is used.
    """
    scored = together(grid, df) if together else None
    if scored is not None:
        found = {(r["trial"], r["fold"]): r["auc_roc"] for r in auc(scored, "prob", label, ["trial", "fold"]).collect()}
        values = [[found.get((j, i)) for i in range(k)] for j in range(len(grid))]
        return _best([(params, float("nan") if None in own else sum(own) / k) for params, own in zip(grid, values)])

    def trial(at: tuple[dict, int]) -> float:
        params, i = at
        model = fit(params, df.where(F.col(fold) != i))
        return _held_out_auc(model, df.where(F.col(fold) == i), label)

    pairs = [(params, i) for params in grid for i in range(k)]
    scores = in_parallel(df.sparkSession, trial, pairs, workers)
    return _best([(params, sum(scores[j * k : (j + 1) * k]) / k) for j, params in enumerate(grid)])


FitBudget = Callable[[dict, DataFrame, int], Model]
_RUNG = "trial int, rung int, budget int, auc double, kept boolean"


def successive_halving(
    fit: FitBudget, trials: Sequence[dict], train: DataFrame, valid: DataFrame, label: str, budgets: Sequence[int],
    store: str, keep: float = 0.5, workers: int = 4,
) -> DataFrame:
    """Rows (trial, rung, budget, auc, kept) of a search that spends its budget on the better trials.

    All trials run with the first budget; the better share by exact validation
    AUC (ties: earlier trials) goes on to the next, the best of the last rung
    is the one kept there. Every rung is written below ``store`` when it is
    complete, and a search that is started again reads the rungs it finds, so a
    lost driver costs one rung. The result does not depend on who finishes first.
    A trial without a value, where one class is missing, ranks last.
    """
    spark = train.sparkSession
    live = list(range(len(trials)))
    for rung, budget in enumerate(budgets):
        path = f"{store.rstrip('/')}/rung={rung}"
        found = {r["trial"]: r for r in read_if_complete(spark, path, _RUNG)}
        if not found:
            scores = in_parallel(spark, lambda t: _held_out_auc(fit(trials[t], train, budget), valid, label), live, workers)  # noqa: B023
            order = sorted(range(len(live)), key=lambda k: (scores[k] != scores[k], -scores[k], live[k]))
            last = rung == len(budgets) - 1
            stay = {live[k] for k in order[: 1 if last else max(1, math.ceil(len(live) * keep))]}
            rows = [(t, rung, budget, None if v != v else float(v), t in stay) for t, v in zip(live, scores)]
            spark.createDataFrame(rows, _RUNG).coalesce(1).write.mode("overwrite").parquet(path)
            live = [t for t in live if t in stay]
        else:
            live = sorted(t for t, r in found.items() if r["kept"])
    return spark.read.schema(_RUNG).parquet(*[f"{store.rstrip('/')}/rung={k}" for k in range(len(budgets))])


# --- calibration ------------------------------------------------------------


class PlattEnsemble:
    """Mean of k fold models, each behind its own sigmoid."""

    def __init__(self, members: Sequence[tuple[Model, float, float]]):
        self.members = list(members)

    def transform(self, df: DataFrame, out: str = "prob") -> DataFrame:
        scored = df
        for i, (model, slope, intercept) in enumerate(self.members):
            scored = raw_margin(model, scored, f"__m{i}")
            scored = scored.withColumn(f"__m{i}", 1 / (1 + F.exp(-(F.lit(slope) * F.col(f"__m{i}") + F.lit(intercept)))))
        names = [f"__m{i}" for i in range(len(self.members))]
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
        return scored.withColumn(out, mean).drop(*names)


def fit_sigmoid(df: DataFrame, margin: str, label: str) -> tuple[float, float]:
    """Platt's sigmoid on held-out margins with his smoothed targets.

    Each row enters twice with complementary weights: an exact way to give a
    logistic fit the soft targets (N+ + 1)/(N+ + 2) and 1/(N- + 2).
    """
    counts = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    high, low = (counts["p"] + 1) / (counts["p"] + 2), 1 / (counts["n"] + 2)
    target = F.when(F.col(label) == 1, high).otherwise(low)
    both = df.select(
        array_to_vector(F.array(F.col(margin))).alias("x"),
        F.inline(F.array(
            F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w"))
        )),
    )
    fit = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", maxIter=100).fit(both)
    return float(fit.coefficients[0]), float(fit.intercept)


def platt_ensemble(
    fit: Fit, df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0, workers: int = 5
) -> PlattEnsemble:
    """Fit on k - 1 folds, calibrate on the held-out one, for each fold; folds share the cluster."""
    folded = cut_lineage(stratified_fold(df, key, label, k, seed))

    def member(i: int) -> tuple[Model, float, float]:
        model = fit(folded.where(F.col("fold") != i))
        held = raw_margin(model, folded.where(F.col("fold") == i))
        return (model, *fit_sigmoid(held, "margin", label))

    return PlattEnsemble(in_parallel(df.sparkSession, member, range(k), workers))


def out_of_fold(
    fit: Fit, df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0, out: str = "prob", workers: int = 5
) -> DataFrame:
    """Every row scored by the model that did not see its fold; folds share the cluster."""

    def fit_folds(folded: DataFrame) -> list[Model]:
        return in_parallel(df.sparkSession, lambda i: fit(folded.where(F.col("fold") != i)), range(k), workers)

    return out_of_fold_together(fit_folds, df, key, label, k, seed, out)


def out_of_fold_together(
    fit_folds: Callable[[DataFrame], Sequence[Model]], df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0, out: str = "prob"
) -> DataFrame:
    """Every row scored by the model that did not see its fold; ``fit_folds`` gives the model of each ``fold`` left out."""
    folded = cut_lineage(stratified_fold(df, key, label, k, seed))
    parts = [positive_probability(model, folded.where(F.col("fold") == i), out) for i, model in enumerate(fit_folds(folded))]
    return reduce(DataFrame.unionByName, parts)


def fit_isotonic(df: DataFrame, score: str, label: str) -> IsotonicRegressionModel:
    """Monotone calibration curve on held-out scores.

    Scores are counted per distinct value first, so the fit sorts weighted
    points instead of rows.
    """
    points = df.groupBy(score).agg(F.avg(label).alias("__y"), F.count("*").cast("double").alias("__w"))
    return IsotonicRegression(featuresCol=score, labelCol="__y", weightCol="__w", predictionCol="__iso").fit(points)


def apply_isotonic(model: IsotonicRegressionModel, df: DataFrame, out: str = "prob_calibrated") -> DataFrame:
    clipped = F.least(F.greatest(F.col("__iso"), F.lit(0.0)), F.lit(1.0))
    return model.transform(df).withColumn(out, clipped).drop("__iso")


# --- attribution ------------------------------------------------------------


def coefficient_rank(model: LogisticRegressionModel, names: Sequence[str], session) -> DataFrame:
    """Feature, coefficient and its size, ranked; a row per feature."""
    rows = sorted(
        ((n, float(c), abs(float(c))) for n, c in zip(names, model.coefficients)), key=lambda r: (-r[2], r[0])
    )
    return session.createDataFrame(
        [(*r, i + 1) for i, r in enumerate(rows)], "feature string, coefficient double, abs_coef double, rank int"
    )


def optimality(model: LogisticRegressionModel, df: DataFrame, label: str, features: str, weight: str, names: Sequence[str]) -> DataFrame:
    """(feature, coefficient, slope, violation): how far each coefficient is from the penalised optimum.

    ``slope`` is the derivative of the weighted mean loss. With penalty r and
    L1 share a, a coefficient b other than zero needs
    slope + r(1 - a)b + ra sign(b) = 0, a zero one needs a slope of at most ra.
    One aggregate over the training rows; the last row is the intercept, which
    is not penalised.
    """
    x, p = vector_to_array(features), vector_to_array("probability")[1]
    rows = model.transform(df).select(x.alias("x"), F.col(weight).alias("w"), (F.col(weight) * (p - F.col(label))).alias("r"))
    penalty, share = model.getRegParam(), model.getElasticNetParam()
    every = [*zip(names, map(float, model.coefficients)), ("(Intercept)", float(model.intercept))]
    parts = []
    for i, (name, b) in enumerate(every):
        slope = F.sum(F.get("x", F.lit(i)) * F.col("r") if i < len(names) else F.col("r")) / F.sum("w")
        parts.append(F.struct(F.lit(name).alias("feature"), F.lit(b).alias("coefficient"), slope.alias("slope")))
    sums = rows.agg(F.array(*parts).alias("a")).select(F.inline("a"))
    b, l1 = F.col("coefficient"), penalty * share
    bent = F.abs(F.col("slope") + penalty * (1 - share) * b + l1 * F.signum(b))
    free = F.abs("slope")
    return sums.withColumn(
        "violation",
        F.when(F.col("feature") == "(Intercept)", free).when(b == 0, F.greatest(free - l1, F.lit(0.0))).otherwise(bent),
    )


def linear_attribution(model: LogisticRegressionModel, df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """Mean |coefficient * (x - mean)| per feature: two aggregates over the matrix."""
    x = vector_to_array(features)
    wide = df.select(x.alias("x"))
    means = wide.agg(F.array(*[F.avg(F.get("x", F.lit(i))) for i in range(len(names))]).alias("m")).scalar()
    row = wide.withColumn("m", means).agg(
        F.array(*[
            F.struct(
                F.lit(n).alias("feature"),
                (F.avg(F.abs(F.get("x", F.lit(i)) - F.get("m", F.lit(i)))) * abs(float(model.coefficients[i]))).alias("mean_abs"),
            )
            for i, n in enumerate(names)
        ]).alias("r")
    )
    return row.select(F.inline("r"))


def permutation_importance(
    model: Model, df: DataFrame, key: str, label: str, features: str, names: Sequence[str], seed: int = 0
) -> DataFrame:
    """AUC lost when one feature is shuffled, all features in one job.

    A row's partner is the next one in the order of a seeded hash of the key,
    the first one after the last; its value replaces the feature. Ranges of
    the hash are sorted apart and only balance the load: the last row of a
    range takes the first row of the next, so that any cut gives the same
    partners. One shuffle serves all features. A row is scored once for itself
    and once for each feature whose value its partner changes.
    """
    ranges = default_buckets(df)
    base = df.select(F.col(key).alias("k"), F.col(label).alias("y"), vector_to_array(features).alias("x"))
    hashed = base.withColumn("h", F.xxhash64(F.col("k"), F.lit(seed))).withColumn(
        "range", F.shiftright("h", 65 - ranges.bit_length())
    )
    order = Window.partitionBy("range").orderBy("h", "k")
    # a row per range
    across = Window.partitionBy(F.lit(1)).orderBy("range")
    firsts = hashed.groupBy("range").agg(F.min_by("x", F.struct("h", "k")).alias("x"))
    following = firsts.select("range", F.coalesce(F.lead("x").over(across), F.first("x").over(across)).alias("after"))
    partnered = hashed.withColumn("z", F.lead("x").over(order)).join(following, "range").withColumn("z", F.coalesce("z", "after"))

    def swap(j: Column) -> Column:
        return F.transform("x", lambda v, i: F.when(i == j, F.element_at("z", (j + 1).cast("int"))).otherwise(v))

    # features whose value stays the same share the score of the row itself (-1)
    every = F.sequence(F.lit(0), F.lit(len(names) - 1))
    stays = lambda j: F.get("x", j).eqNullSafe(F.get("z", j))
    kept = F.concat(F.array(F.lit(-1)), F.filter(every, stays))
    moved = F.transform(F.filter(every, lambda j: ~stays(j)), lambda j: F.array(j))
    copies = partnered.select("y", "x", "z", F.explode(F.concat(F.array(kept), moved)).alias("js"))
    scored = positive_probability(model, copies.select("y", "js", array_to_vector(swap(F.get("js", F.lit(0)))).alias(features)))
    per_feature = auc(scored.select("y", "prob", F.explode("js").alias("j")), "prob", "y", ["j"])
    baseline = per_feature.where("j = -1").select("auc_roc").scalar()
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("j"))
    return (
        per_feature.withColumn("base", baseline)
        .where("j >= 0")
        .select(name.alias("feature"), (F.col("base") - F.col("auc_roc")).alias("auc_drop"))
    )


def prepare(train: DataFrame, label: str) -> tuple[DataFrame, float]:
    """Training rows with balanced weights and the total weight."""
    weighted = with_class_weight(train, label)
    return weighted, float(weighted.agg(F.sum("class_weight")).first()[0])
