"""Exact evaluation of binary scores, for any number of groups in one plan.

Everything starts from the curve: per group and distinct score the positives
and negatives, with running sums from the highest score down. AUC, average
precision, Brier score and every threshold metric are single aggregates over
it, so a full metric row costs one ordering of the distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.ordered import running_totals, with_bin


def score_curve(df: DataFrame, score: str, label: str, groups: Sequence[str] = (), totals: bool = False) -> DataFrame:
    """Rows (groups, score, pos, neg, cum_pos, cum_neg), sums by descending score.

    Rows without a score, a label or a group take no part. ``totals`` adds the
    group's total_pos and total_neg.
    """
    needed = [score, label, *groups]
    complete = df.dropna(subset=needed).select(*groups, F.col(score).alias("score"), F.col(label).alias("label"))
    measures = {
        "pos": F.sum(F.col("label").cast("long")),
        "neg": F.sum(1 - F.col("label").cast("long")),
    }
    return running_totals(complete, "score", measures, groups, descending=True, totals=totals)


def auc_agg() -> Column:
    """Aggregate over a curve: AUC with ties averaged, NULL for one class only."""
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    wins = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    return F.when((pos > 0) & (neg > 0), wins / (pos * neg))


def average_precision_agg() -> Column:
    """Aggregate over a curve: step-wise average precision."""
    pos = F.sum("pos")
    steps = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return F.when(pos > 0, steps / pos)


def brier_agg() -> Column:
    """Aggregate over a curve: mean squared error of the score."""
    s = F.col("score")
    total = F.sum(F.col("pos") * (s - 1) * (s - 1) + F.col("neg") * s * s)
    return total / F.sum(F.col("pos") + F.col("neg"))


def flagged_aggs(tau: float) -> dict[str, Column]:
    """Aggregates over a curve: the counts behind every threshold metric."""
    over = F.col("score") >= F.lit(tau)
    return {
        "n": F.sum(F.col("pos") + F.col("neg")),
        "n_positive": F.sum("pos"),
        "flagged_n": F.coalesce(F.sum(F.when(over, F.col("pos") + F.col("neg"))), F.lit(0)),
        "tp": F.coalesce(F.sum(F.when(over, F.col("pos"))), F.lit(0)),
    }


def _ratio(num: str, den: str, empty: float | None) -> Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(empty).cast("double"))


def metric_row(df: DataFrame, score: str, label: str, tau: float, groups: Sequence[str] = ()) -> DataFrame:
    """Full metric row per group at threshold ``tau``.

    With nothing flagged precision, recall and F1 are 0.
    """
    curve = score_curve(df, score, label, groups)
    counts = curve.groupBy(*groups).agg(
        auc_agg().alias("auc_roc"),
        average_precision_agg().alias("auc_pr"),
        brier_agg().alias("brier"),
        *[e.alias(n) for n, e in flagged_aggs(tau).items()],
    )
    precision, recall = _ratio("tp", "flagged_n", 0.0), _ratio("tp", "n_positive", 0.0)
    f1_den = F.col("flagged_n") + F.col("n_positive")
    return counts.select(
        *groups,
        "n",
        F.lit(tau).alias("tau"),
        "auc_roc",
        "auc_pr",
        "brier",
        "flagged_n",
        (F.col("flagged_n") / F.col("n")).alias("flagged_rate"),
        precision.alias("flagged_pos_rate"),
        precision.alias("precision_tau"),
        recall.alias("recall_tau"),
        F.when((F.col("tp") > 0) & (f1_den > 0), 2 * F.col("tp") / f1_den).otherwise(0.0).alias("f1_tau"),
    )


def auc(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    return score_curve(df, score, label, groups).groupBy(*groups).agg(auc_agg().alias("auc_roc"))


def average_precision(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    return score_curve(df, score, label, groups).groupBy(*groups).agg(average_precision_agg().alias("auc_pr"))


def brier(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Mean squared error of the score; needs no ordering, so one plain aggregate."""
    gap = F.col(score) - F.col(label)
    return df.dropna(subset=[score, label, *groups]).groupBy(*groups).agg(F.avg(gap * gap).alias("brier"))


def threshold_metrics(df: DataFrame, score: str, label: str, tau: float, groups: Sequence[str] = ()) -> DataFrame:
    """Flag counts and rates at one threshold: one conditional aggregate, no ordering."""
    over = F.col(score) >= F.lit(tau)
    counts = (
        df.dropna(subset=[score, label, *groups])
        .groupBy(*groups)
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col(label).cast("long")).alias("n_positive"),
            F.count_if(over).alias("flagged_n"),
            F.count_if(over & (F.col(label) == 1)).alias("tp"),
        )
    )
    f1_den = F.col("flagged_n") + F.col("n_positive")
    return counts.select(
        *groups,
        "n",
        "flagged_n",
        (F.col("flagged_n") / F.col("n")).alias("flagged_rate"),
        _ratio("tp", "flagged_n", 0.0).alias("precision_tau"),
        _ratio("tp", "n_positive", 0.0).alias("recall_tau"),
        F.when((F.col("tp") > 0) & (f1_den > 0), 2 * F.col("tp") / f1_den).otherwise(0.0).alias("f1_tau"),
    )


def threshold_sweep(
    df: DataFrame, score: str, label: str, taus: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """Threshold metrics for every tau from one pass over the rows.

    A row is counted once, in the cell between two neighbouring taus; suffix
    sums over the cells (at most ``len(taus) + 1`` rows per group) give each
    tau its counts. F1 carries the 1e-9 guard of the sweep definition.
    """
    groups = list(groups)
    taus = sorted(taus)
    binned = with_bin(df.dropna(subset=[score, label, *groups]), score, taus, "cell", inclusive=True)
    cells = binned.groupBy(*groups, "cell").agg(
        F.count("*").alias("c"), F.sum(F.col(label).cast("long")).alias("p")
    )
    totals = cells.groupBy(*groups).agg(F.sum("c").alias("n"), F.sum("p").alias("n_positive"))
    axis = totals.select(
        *groups, "n", "n_positive", F.posexplode(F.array(*[F.lit(float(t)) for t in taus])).alias("i", "tau")
    ).withColumn("cell", F.col("i") + 1)
    dense = axis.join(cells, [*groups, "cell"], "left")
    above = Window.partitionBy(*groups).orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    sums = dense.withColumns(
        {
            "flagged_n": F.sum(F.coalesce("c", F.lit(0))).over(above),
            "tp": F.sum(F.coalesce("p", F.lit(0))).over(above),
        }
    )
    rates = sums.select(
        *groups,
        "tau",
        "flagged_n",
        (F.col("flagged_n") / F.col("n")).alias("flagged_rate"),
        _ratio("tp", "flagged_n", 0.0).alias("precision_tau"),
        F.when(F.col("flagged_n") > 0, _ratio("tp", "n_positive", 0.0)).otherwise(0.0).alias("recall_tau"),
    )
    p, r = F.col("precision_tau"), F.col("recall_tau")
    return rates.withColumn("f1_tau", 2 * p * r / (p + r + F.lit(1e-9)))


def reliability(df: DataFrame, score: str, label: str, bins: int = 10, groups: Sequence[str] = ()) -> DataFrame:
    """Mean score and observed rate in uniform, right-closed bins; empty bins drop out."""
    edges = [i / bins for i in range(1, bins)]
    binned = with_bin(df.dropna(subset=[score, label, *groups]), score, edges, "bin")
    return binned.groupBy(*groups, "bin").agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("observed_rate")
    )


def roc_points(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """One (fpr, tpr) point per distinct score, and the start (0, 0) with a NULL threshold.

    Groups with one class have no points.
    """
    return _curve_points(
        df, score, label, groups,
        fpr=(0.0, F.col("cum_neg") / F.col("total_neg")),
        tpr=(0.0, F.col("cum_pos") / F.col("total_pos")),
    )


def pr_points(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """One (precision, recall) point per distinct score, and the end (1, 0) with a NULL threshold."""
    return _curve_points(
        df, score, label, groups,
        precision=(1.0, F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))),
        recall=(0.0, F.col("cum_pos") / F.col("total_pos")),
    )


def _curve_points(df, score, label, groups, **points: tuple[float, Column]) -> DataFrame:
    """Points by name: the value above every score, and the value at a score."""
    curve = score_curve(df, score, label, groups, totals=True).where("total_pos > 0 AND total_neg > 0")
    # the highest score of a group is where the sums hold that row alone
    highest = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    copies = F.when(highest, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    rows = curve.withColumn("__end", F.explode(copies))
    return rows.select(
        *groups,
        F.when(~F.col("__end"), F.col("score")).alias("threshold"),
        *[F.when(F.col("__end"), F.lit(end)).otherwise(at).alias(n) for n, (end, at) in points.items()],
    )


def split_gap(metrics: DataFrame, model: str, split: str, metric: str, first: str, second: str) -> DataFrame:
    """Metric per model with splits side by side and their difference."""
    return (
        metrics.groupBy(model)
        .agg(
            F.max(F.when(F.col(split) == first, F.col(metric))).alias(f"{first}_{metric}"),
            F.max(F.when(F.col(split) == second, F.col(metric))).alias(f"{second}_{metric}"),
        )
        .withColumn("gap", F.col(f"{first}_{metric}") - F.col(f"{second}_{metric}"))
    )


def subgroup_metrics(
    df: DataFrame, score: str, label: str, tau: float, attributes: Sequence[str], min_rows: int = 50
) -> DataFrame:
    """Metrics per value of each attribute, groups under ``min_rows`` left out.

    All attributes share one plan: rows are unpivoted to (attribute, level)
    and combined per distinct score before the shuffle. NULL levels drop out.
    """
    slim = df.dropna(subset=[score, label]).select(
        F.col(score).alias("score"), F.col(label).alias("label"), *[F.col(a).cast("string").alias(a) for a in attributes]
    )
    long = slim.unpivot(["score", "label"], list(attributes), "attribute", "level").where("level IS NOT NULL")
    counts = (
        score_curve(long, "score", "label", ["attribute", "level"])
        .groupBy("attribute", "level")
        .agg(auc_agg().alias("auc_roc"), *[e.alias(n) for n, e in flagged_aggs(tau).items()])
        .where(F.col("n") >= min_rows)
    )
    return counts.select(
        "attribute",
        "level",
        "n",
        (F.col("n_positive") / F.col("n")).alias("positive_rate"),
        (F.col("flagged_n") / F.col("n")).alias("flag_rate"),
        "auc_roc",
        _ratio("tp", "flagged_n", None).alias("precision_tau"),
        _ratio("tp", "n_positive", None).alias("recall_tau"),
    )


def disparity(
    df: DataFrame, score: str, label: str, tau: float, attribute: str, min_rows: int = 50, limit: float = 1.5
) -> DataFrame:
    """Flag rate relative to the positive rate per level, and who exceeds the limit."""
    flagged = (F.col(score) >= F.lit(tau)).cast("int")
    levels = (
        df.dropna(subset=[score, label, attribute])
        .groupBy(F.col(attribute).alias("level"))
        .agg(F.count("*").alias("n"), F.avg(label).alias("positive_rate"), F.avg(flagged).alias("flag_rate"))
        .where(F.col("n") >= min_rows)
    )
    return levels.withColumn(
        "disparity_ratio", F.when(F.col("positive_rate") > 0, F.round(F.col("flag_rate") / F.col("positive_rate"), 2))
    ).withColumn("over_flagged", F.coalesce(F.col("disparity_ratio") > limit, F.lit(False)))


def disparity_extremes(levels: DataFrame) -> DataFrame:
    """Level with the highest and the lowest disparity ratio (first name on ties)."""
    key = F.struct("disparity_ratio", F.col("level"))
    return levels.where("disparity_ratio IS NOT NULL").agg(
        F.min(F.struct(-F.col("disparity_ratio"), "level"))["level"].alias("highest"),
        F.max("disparity_ratio").alias("highest_ratio"),
        F.min(key)["level"].alias("lowest"),
        F.min("disparity_ratio").alias("lowest_ratio"),
        F.count_if("over_flagged").alias("n_over_flagged"),
    )


def rank_features(attributions: DataFrame, model: str, feature: str, value: str) -> DataFrame:
    """Rank per model, 1 = largest value; equal values in name order.

    The input holds one row per model and feature, a report-sized table.
    """
    order = Window.partitionBy(model).orderBy(F.desc(value), feature)
    return attributions.withColumn("rank", F.row_number().over(order))


def compare_ranks(
    ranked: DataFrame, model: str, feature: str, models: Sequence[str], lead: str, k: int, missing: int
) -> DataFrame:
    """Ranks of the lead model's k best features under every model.

    A feature a model does not list gets the ``missing`` rank.
    """
    wide = ranked.groupBy(feature).agg(
        *[F.min(F.when(F.col(model) == m, F.col("rank"))).alias(f"rank_{m}") for m in models]
    )
    return wide.where(F.col(f"rank_{lead}") <= k).select(
        feature, *[F.coalesce(f"rank_{m}", F.lit(missing)).alias(f"rank_{m}") for m in models]
    )


def rank_of_match(ranked: DataFrame, model: str, feature: str, text: str) -> DataFrame:
    """Best rank among the features whose name contains the text, per model."""
    return ranked.where(F.col(feature).contains(text)).groupBy(model).agg(F.min("rank").alias("rank"))


def direction_check(expected: DataFrame, coefficients: DataFrame, feature: str) -> DataFrame:
    """Expected sign against the sign of the fitted coefficient.

    A feature without a coefficient, or with 0, counts as zeroed; it neither
    confirms nor contradicts.
    """
    joined = expected.join(coefficients, feature, "left")
    sign = F.signum("coefficient")
    return joined.select(
        feature,
        "expected_sign",
        "coefficient",
        F.when(F.coalesce(F.col("coefficient"), F.lit(0.0)) == 0, "zeroed")
        .when(sign == F.signum("expected_sign"), "yes")
        .otherwise("no")
        .alias("consistent"),
    )
