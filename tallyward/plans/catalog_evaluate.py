"""Catalog: evaluation of the pseudo-score by split, subgroup and threshold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions.scalar import near_any
from tallyward.operators import evaluate as E
from tallyward.operators.profile import mean_abs_ranked
from tallyward.plans import encounter_rules as R
from tallyward.plans.catalog_base import Catalog, mart, rounded, with_steps
from tallyward.sources.fixtures import table

catalog = Catalog()
query = catalog.query

GROUPS = ["split_group"]
SCORED = "SELECT split_group, readmitted_30day AS y, prob AS s, race, age_group, diag_1_group, gender FROM mart"


def scored(body: str, **more: str) -> str:
    return with_steps("mart", body, sc=SCORED, **more)


def scores(spark, d):
    return mart(spark, d, R.LABEL, "prob", "race", "age_group", "diag_1_group", "gender").select(
        "split_group", F.col(R.LABEL).alias("y"), F.col("prob").alias("s"), "race", "age_group", "diag_1_group", "gender"
    )


SQL_AUC = """SELECT {g}, CASE WHEN n1 > 0 AND n0 > 0 THEN ROUND((r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) END AS auc_roc FROM (
  SELECT {g}, SUM(y) AS n1, SUM(1 - y) AS n0, COALESCE(SUM(r) FILTER (WHERE y = 1), 0) AS r1 FROM (
    SELECT {g}, y, RANK() OVER (PARTITION BY {g} ORDER BY s) + (COUNT(*) OVER (PARTITION BY {g}, s) - 1) / 2.0 AS r FROM {src})
  GROUP BY {g})"""
SQL_CUM = """SELECT {g}, s, pos, neg, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM (
  SELECT {g}, s, SUM(y) AS pos, SUM(1 - y) AS neg FROM {src} GROUP BY {g}, s) WINDOW w AS (PARTITION BY {g} ORDER BY s DESC)"""
SQL_AP = "SELECT {g}, CASE WHEN SUM(pos) > 0 THEN ROUND(SUM(pos * tp / (tp + fp)) / SUM(pos), 6) END AS auc_pr FROM cum GROUP BY {g}"


@query("auc_by_split", scored(SQL_AUC.format(g="split_group", src="sc")))
def _(spark, d):
    return rounded(E.auc(scores(spark, d), "s", "y", GROUPS), "auc_roc")


@query(
    "avg_precision",
    scored(SQL_AP.format(g="split_group"), cum=SQL_CUM.format(g="split_group", src="sc")),
)
def _(spark, d):
    return rounded(E.average_precision(scores(spark, d), "s", "y", GROUPS), "auc_pr")


@query("brier", scored("SELECT split_group, ROUND(AVG((s - y) * (s - y)), 6) AS brier FROM sc GROUP BY 1"))
def _(spark, d):
    return rounded(E.brier(scores(spark, d), "s", "y", GROUPS), "brier")


def _sql_threshold(tau, g="split_group"):
    return (
        f"SELECT {g}, n, flagged_n, ROUND(flagged_n / n, 6) AS flagged_rate, "
        f"CASE WHEN flagged_n > 0 THEN ROUND(tp / flagged_n, 6) ELSE 0.0 END AS precision_tau, "
        f"CASE WHEN p > 0 THEN ROUND(tp / p, 6) ELSE 0.0 END AS recall_tau, "
        f"CASE WHEN tp > 0 THEN ROUND(2 * (tp / flagged_n) * (tp / p) / (tp / flagged_n + tp / p), 6) ELSE 0.0 END AS f1_tau FROM ("
        f"SELECT {g}, COUNT(*) AS n, SUM(y) AS p, COUNT(*) FILTER (WHERE s >= {tau}) AS flagged_n, "
        f"COUNT(*) FILTER (WHERE s >= {tau} AND y = 1) AS tp FROM sc GROUP BY {g})"
    )


@query("threshold_metrics", scored(_sql_threshold(0.12)))
def _(spark, d):
    out = E.threshold_metrics(scores(spark, d), "s", "y", R.DEPLOYED_TAU, GROUPS)
    return rounded(out, "flagged_rate", "precision_tau", "recall_tau", "f1_tau")


@query("threshold_nothing_flagged", scored(_sql_threshold(0.99)))
def _(spark, d):
    out = E.threshold_metrics(scores(spark, d), "s", "y", 0.99, GROUPS)
    return rounded(out, "flagged_rate", "precision_tau", "recall_tau", "f1_tau")


SQL_METRICS = (
    "SELECT split_group, n, CAST(0.10 AS DOUBLE) AS tau, auc_roc, auc_pr, brier, flagged_n, flagged_rate, "
    "precision_tau AS flagged_pos_rate, precision_tau, recall_tau, f1_tau FROM a JOIN p USING (split_group) "
    "JOIN b USING (split_group) JOIN t USING (split_group)"
)


def metrics(spark, d):
    return E.metric_row(scores(spark, d), "s", "y", R.TRAINING_TAU, GROUPS)


@query(
    "metric_rows",
    scored(
        SQL_METRICS,
        cum=SQL_CUM.format(g="split_group", src="sc"),
        a=SQL_AUC.format(g="split_group", src="sc"),
        p=SQL_AP.format(g="split_group"),
        b="SELECT split_group, ROUND(AVG((s - y) * (s - y)), 6) AS brier FROM sc GROUP BY 1",
        t=_sql_threshold(0.10),
    ),
)
def _(spark, d):
    return rounded(
        metrics(spark, d),
        "auc_roc", "auc_pr", "brier", "flagged_rate", "flagged_pos_rate", "precision_tau", "recall_tau", "f1_tau",
    )


SWEEP_TAUS = [round(0.10 + 0.01 * i, 2) for i in range(6)]
FINE_TAUS = [0.02 + i * (0.40 - 0.02) / 199 for i in range(200)]


def _sql_sweep(taus):
    values = ", ".join(f"({t!r})" for t in taus)
    return (
        "SELECT split_group, tau, flagged_n, ROUND(flagged_n / n, 6) AS flagged_rate, ROUND(pr, 6) AS precision_tau, "
        "ROUND(rc, 6) AS recall_tau, ROUND(2 * pr * rc / (pr + rc + 1e-9), 6) AS f1_tau FROM ("
        "SELECT split_group, tau, n, flagged_n, CASE WHEN flagged_n > 0 THEN tp / flagged_n ELSE 0.0 END AS pr, "
        "CASE WHEN flagged_n > 0 THEN tp / p ELSE 0.0 END AS rc FROM ("
        "SELECT split_group, tau, COUNT(*) AS n, SUM(y) AS p, COUNT(*) FILTER (WHERE s >= tau) AS flagged_n, "
        "COUNT(*) FILTER (WHERE s >= tau AND y = 1) AS tp FROM sc, (SELECT CAST(col0 AS DOUBLE) AS tau FROM (VALUES "
        f"{values})) GROUP BY 1, 2))"
    )


@query("threshold_sweep", scored(_sql_sweep(SWEEP_TAUS)))
def _(spark, d):
    out = E.threshold_sweep(scores(spark, d), "s", "y", SWEEP_TAUS, GROUPS)
    return rounded(out, "flagged_rate", "precision_tau", "recall_tau", "f1_tau")


@query("threshold_sweep_fine", scored(_sql_sweep(FINE_TAUS)))
def _(spark, d):
    out = E.threshold_sweep(scores(spark, d), "s", "y", FINE_TAUS, GROUPS)
    return rounded(out, "flagged_rate", "precision_tau", "recall_tau", "f1_tau")


KEY_TAUS = [0.05, 0.08, 0.10, 0.12, 0.15, 0.20, 0.25]


@query(
    "operating_points",
    scored(
        "SELECT * FROM sw WHERE split_group = 'holdout' AND flagged_n > 0 AND (" + " OR ".join(f"ABS(tau - {k}) < 0.005" for k in KEY_TAUS) + ")",
        sw=_sql_sweep(FINE_TAUS),
    ),
)
def _(spark, d):
    out = E.threshold_sweep(scores(spark, d), "s", "y", FINE_TAUS, GROUPS)
    picked = out.where((F.col("split_group") == "holdout") & (F.col("flagged_n") > 0) & near_any("tau", KEY_TAUS, 0.005))
    return rounded(picked, "flagged_rate", "precision_tau", "recall_tau", "f1_tau")


SQL_EDGES = " + ".join(f"CASE WHEN s > {i / 10} THEN 1 ELSE 0 END" for i in range(1, 10))


@query(
    "reliability_curve",
    scored(
        f"SELECT split_group, CAST({SQL_EDGES} AS INTEGER) AS bin, COUNT(*) AS n, ROUND(AVG(s), 6) AS mean_score, "
        "ROUND(AVG(y), 6) AS observed_rate FROM sc GROUP BY 1, 2"
    ),
)
def _(spark, d):
    return rounded(E.reliability(scores(spark, d), "s", "y", 10, GROUPS), "mean_score", "observed_rate")


@query(
    "roc_points",
    scored(
        "SELECT split_group, s AS threshold, ROUND(fp / SUM(neg) OVER g, 6) AS fpr, ROUND(tp / SUM(pos) OVER g, 6) AS tpr "
        "FROM cum WINDOW g AS (PARTITION BY split_group) UNION ALL SELECT DISTINCT split_group, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM cum",
        cum=SQL_CUM.format(g="split_group", src="sc"),
    ),
)
def _(spark, d):
    return rounded(E.roc_points(scores(spark, d), "s", "y", GROUPS), "fpr", "tpr")


@query(
    "pr_points",
    scored(
        'SELECT split_group, s AS threshold, ROUND(tp / (tp + fp), 6) AS "precision", ROUND(tp / SUM(pos) OVER g, 6) AS recall '
        "FROM cum WINDOW g AS (PARTITION BY split_group) UNION ALL SELECT DISTINCT split_group, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM cum",
        cum=SQL_CUM.format(g="split_group", src="sc"),
    ),
)
def _(spark, d):
    return rounded(E.pr_points(scores(spark, d), "s", "y", GROUPS), "precision", "recall")


def compare_models(scores, tau: float):
    """Per model: AUC on training and validation rows, their gap, and recall and flags at the threshold."""
    rows = E.metric_row(scores, "p", "y", tau, ["model", "split_group"])
    gap = E.split_gap(rows, "model", "split_group", "auc_roc", "train", "validation")
    at_tau = rows.where("split_group = 'validation'").select(
        "model", F.col("recall_tau").alias("validation_recall"), F.col("flagged_rate").alias("validation_flagged_rate")
    )
    return gap.join(at_tau, "model")


@query(
    "model_gap",
    scored(
        "SELECT model, ROUND(MAX(CASE WHEN split_group = 'train' THEN auc_roc END), 6) AS train_auc_roc, "
        "ROUND(MAX(CASE WHEN split_group = 'validation' THEN auc_roc END), 6) AS validation_auc_roc, "
        "ROUND(MAX(CASE WHEN split_group = 'train' THEN auc_roc END) - MAX(CASE WHEN split_group = 'validation' THEN auc_roc END), 6) AS gap, "
        "ROUND(MAX(rc), 6) AS validation_recall, ROUND(MAX(fr), 6) AS validation_flagged_rate FROM a JOIN t USING (model) GROUP BY model",
        ms="SELECT 'score' AS model, split_group, y, s FROM sc UNION ALL SELECT 'squared', split_group, y, s * s FROM sc",
        a="SELECT model, split_group, (r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS auc_roc FROM (SELECT model, split_group, SUM(y) AS n1, SUM(1 - y) AS n0, "
        "SUM(r) FILTER (WHERE y = 1) AS r1 FROM (SELECT model, split_group, y, RANK() OVER (PARTITION BY model, split_group ORDER BY s) "
        "+ (COUNT(*) OVER (PARTITION BY model, split_group, s) - 1) / 2.0 AS r FROM ms) GROUP BY 1, 2)",
        t="SELECT model, COUNT(*) FILTER (WHERE s >= 0.12) / COUNT(*) AS fr, COUNT(*) FILTER (WHERE s >= 0.12 AND y = 1) / SUM(y) AS rc "
        "FROM ms WHERE split_group = 'validation' GROUP BY 1",
    ),
)
def _(spark, d):
    # two models: the score and its square, which orders rows the same way
    s = scores(spark, d)
    both = s.select("split_group", "y", F.inline(F.array(
        F.struct(F.lit("score").alias("model"), F.col("s").alias("p")),
        F.struct(F.lit("squared").alias("model"), (F.col("s") * F.col("s")).alias("p")),
    )))
    return rounded(
        compare_models(both, R.DEPLOYED_TAU),
        "train_auc_roc", "validation_auc_roc", "gap", "validation_recall", "validation_flagged_rate",
    )


ATTRIBUTES = ["race", "age_group", "diag_1_group", "gender"]
SQL_LONG = " UNION ALL ".join(f"SELECT '{a}' AS attribute, {a} AS level, y, s FROM sc WHERE {a} IS NOT NULL" for a in ATTRIBUTES)


@query(
    "subgroup_metrics",
    scored(
        "SELECT attribute, level, n, ROUND(p / n, 6) AS positive_rate, ROUND(fl / n, 6) AS flag_rate, "
        "CASE WHEN p > 0 AND p < n THEN ROUND((r1 - p * (p + 1) / 2.0) / (p * (n - p)), 6) END AS auc_roc, "
        "CASE WHEN fl > 0 THEN ROUND(tp / fl, 6) END AS precision_tau, CASE WHEN p > 0 THEN ROUND(tp / p, 6) END AS recall_tau FROM ("
        "SELECT attribute, level, COUNT(*) AS n, SUM(y) AS p, SUM(r) FILTER (WHERE y = 1) AS r1, COUNT(*) FILTER (WHERE s >= 0.12) AS fl, "
        "COUNT(*) FILTER (WHERE s >= 0.12 AND y = 1) AS tp FROM (SELECT *, RANK() OVER (PARTITION BY attribute, level ORDER BY s) "
        "+ (COUNT(*) OVER (PARTITION BY attribute, level, s) - 1) / 2.0 AS r FROM lg) GROUP BY 1, 2) WHERE n >= 50",
        lg=SQL_LONG,
    ),
)
def _(spark, d):
    out = E.subgroup_metrics(scores(spark, d), "s", "y", R.DEPLOYED_TAU, ATTRIBUTES)
    return rounded(out, "positive_rate", "flag_rate", "auc_roc", "precision_tau", "recall_tau")


SQL_DISPARITY = (
    "SELECT level, n, ROUND(pr, 6) AS positive_rate, ROUND(fr, 6) AS flag_rate, CASE WHEN pr > 0 THEN ROUND(fr / pr, 2) END AS disparity_ratio, "
    "COALESCE(ROUND(fr / pr, 2) > 1.5, FALSE) AS over_flagged FROM (SELECT race AS level, COUNT(*) AS n, AVG(y) AS pr, "
    "AVG(CASE WHEN s >= 0.12 THEN 1 ELSE 0 END) AS fr FROM sc GROUP BY 1) WHERE n >= 50"
)


@query("disparity_ratio", scored(SQL_DISPARITY))
def _(spark, d):
    out = E.disparity(scores(spark, d), "s", "y", R.DEPLOYED_TAU, "race")
    return rounded(out, "positive_rate", "flag_rate")


@query(
    "disparity_extremes",
    scored(
        "SELECT FIRST(level ORDER BY disparity_ratio DESC, level) AS highest, MAX(disparity_ratio) AS highest_ratio, "
        "FIRST(level ORDER BY disparity_ratio, level) AS lowest, MIN(disparity_ratio) AS lowest_ratio, "
        "COUNT(*) FILTER (WHERE over_flagged) AS n_over_flagged FROM dp",
        dp=SQL_DISPARITY,
    ),
)
def _(spark, d):
    return E.disparity_extremes(E.disparity(scores(spark, d), "s", "y", R.DEPLOYED_TAU, "race"))


# attributions stand-in: mean price of each line number and quantity under
# every return flag; the three flags are the column's whole domain
RANK_MODELS = ["A", "N", "R"]
SQL_ATTR = (
    "SELECT l_returnflag AS model, CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_quantity AS INTEGER) AS feature, "
    "ROUND(AVG(l_extendedprice), 6) AS value FROM lineitem GROUP BY 1, 2"
)


def attributions(spark, d):
    feature = F.concat(F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_quantity").cast("int").cast("string"))
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model"), feature.alias("feature")).agg(
        F.round(F.avg("l_extendedprice"), 6).alias("value")
    )


@query(
    "rank_compare",
    "WITH a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY value DESC, feature) AS rk FROM (" + SQL_ATTR + ")) "
    "SELECT feature, " + ", ".join(
        f"CAST(COALESCE(MIN(rk) FILTER (WHERE model = '{m}'), 75) AS INTEGER) AS rank_{i + 1}" for i, m in enumerate(RANK_MODELS)
    ) + f" FROM a GROUP BY 1 HAVING MIN(rk) FILTER (WHERE model = '{RANK_MODELS[0]}') <= 10",
)
def _(spark, d):
    ranked = E.rank_features(attributions(spark, d), "model", "feature", "value")
    out = E.compare_ranks(ranked, "model", "feature", RANK_MODELS, RANK_MODELS[0], 10, 75)
    return out.toDF("feature", *[f"rank_{i + 1}" for i in range(len(RANK_MODELS))])


@query(
    "rank_of_match",
    "SELECT model, CAST(MIN(rk) AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY value DESC, feature) AS rk FROM ("
    + SQL_ATTR + ")) WHERE contains(feature, '-4') GROUP BY 1",
)
def _(spark, d):
    ranked = E.rank_features(attributions(spark, d), "model", "feature", "value")
    return E.rank_of_match(ranked, "model", "feature", "-4")


EXPECTED = [("number_inpatient", 1), ("time_in_hospital", 1), ("number_diagnoses", -1), ("num_medications", 1), ("not_fitted", 1)]


@query(
    "direction_check",
    with_steps(
        "mart",
        "SELECT feature, expected_sign, ROUND(coefficient, 6) AS coefficient, CASE WHEN COALESCE(coefficient, 0) = 0 THEN 'zeroed' "
        "WHEN SIGN(coefficient) = SIGN(expected_sign) THEN 'yes' ELSE 'no' END AS consistent FROM (VALUES "
        + ", ".join(str(e) for e in EXPECTED)
        + ") AS e(feature, expected_sign) LEFT JOIN c USING (feature)",
        c=" UNION ALL ".join(
            f"SELECT '{f}' AS feature, covar_pop(readmitted_30day, {f}) / var_pop({f}) AS coefficient FROM mart WHERE split_group = 'train'"
            for f, _ in EXPECTED if f != "not_fitted"
        ),
    ),
)
def _(spark, d):
    # coefficient stand-in: the slope of the label on each feature, one pass
    fitted = [f for f, _ in EXPECTED if f != "not_fitted"]
    train = mart(spark, d, R.LABEL, *fitted).where("split_group = 'train'")
    slopes = train.agg(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.covar_pop(R.LABEL, f) / F.var_pop(f)).alias("coefficient"))
        for f in fitted
    ]).alias("r")).select(F.inline("r"))
    expected = spark.createDataFrame(EXPECTED, "feature string, expected_sign int")
    return rounded(E.direction_check(expected, slopes, "feature"), "coefficient")
