"""Catalog: feature matrix, classifiers, calibration, attribution, streaming."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators import evaluate as E
from tallyward.operators import models as M
from tallyward.operators.drift import fit_psi_reference, psi_from_counts
from tallyward.operators.features import fit_features
from tallyward.operators.isotonic import apply_blocks, isotonic_blocks
from tallyward.operators.network_paths import gradient_attribution, gradient_contributions
from tallyward.operators.tree_paths import path_contributions
from tallyward.plans import encounter_rules as R
from tallyward.plans import risk_model as K
from tallyward.plans.catalog_base import Catalog, mart, rounded, with_steps
from tallyward.plans.catalog_drift import SQL_KS, psi_steps
from tallyward.plans.catalog_evaluate import compare_models
from tallyward.session import cut_lineage, materialize, scratch_path
from tallyward.sources.fixtures import table
from tallyward.sources.readers import to_requests
from tallyward.streaming import jobs as S
from tallyward.streaming import windows as SW

catalog = Catalog()
query = catalog.query

SCALED = ["age_midpoint", "time_in_hospital", "num_lab_procedures", "number_inpatient", "total_prior_encounters"]


def train(df):
    return df.where("split_group = 'train'")


@query(
    "standard_scale",
    with_steps(
        "mart",
        "SELECT encounter_id, " + ", ".join(f"ROUND(({c} - f.m_{c}) / f.s_{c}, 6) AS numeric__{c}" for c in SCALED) + " FROM mart, f",
        f="SELECT " + ", ".join(f"AVG({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED) + " FROM mart WHERE split_group = 'train'",
    ),
)
def _(spark, d):
    m = mart(spark, d, *SCALED)
    plan = fit_features(train(m), SCALED, [], [])
    return rounded(plan.columns(m, ["encounter_id"]), *plan.names())


def _sql_ordinal(col, order):
    arms = " ".join(f"WHEN '{v}' THEN {i}.0" for i, v in enumerate(order))
    return f"CAST(CASE {col} {arms} ELSE -1.0 END AS DOUBLE)"


ORDINALS = [
    ("med_ord", "metformin", R.MEDICATION_ORDER),
    ("med_ord", "repaglinide", R.MEDICATION_ORDER),
    ("med_ord", "insulin", R.MEDICATION_ORDER),
    ("a1c_ord", "a1cresult", R.A1C_ORDER),
    ("glu_ord", "max_glu_serum", R.GLUCOSE_ORDER),
    ("age_ord", "age_group", ["young", "middle"]),  # 'senior' is unknown to this order
]


@query(
    "ordinal_encode",
    with_steps("mart", "SELECT encounter_id, " + ", ".join(f"{_sql_ordinal(c, o)} AS {g}__{c}" for g, c, o in ORDINALS) + " FROM mart"),
)
def _(spark, d):
    m = mart(spark, d, *[c for _, c, _ in ORDINALS])
    return fit_features(train(m), [], ORDINALS, []).columns(m, ["encounter_id"])


HOT = ["race", "admission_type_group", "age_group"]


@query(
    "one_hot_drop_first",
    with_steps(
        "mart",
        "SELECT encounter_id, variable, level, CAST(CASE WHEN v = level THEN 1 ELSE 0 END AS DOUBLE) AS hot FROM r JOIN k USING (variable)",
        lv=" UNION ALL ".join(f"SELECT DISTINCT '{c}' AS variable, {c} AS level FROM mart WHERE split_group = 'train' AND {c} IS NOT NULL" for c in HOT),
        k="SELECT variable, level FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY variable ORDER BY level) AS i FROM lv) WHERE i > 1",
        r=" UNION ALL ".join(f"SELECT encounter_id, '{c}' AS variable, {c} AS v FROM mart" for c in HOT),
    ),
)
def _(spark, d):
    # wide dummies opened to rows, so that SQL need not know the names
    m = mart(spark, d, *HOT)
    plan = fit_features(train(m), [], [], HOT)
    wide = plan.columns(m, ["encounter_id"])
    names = F.create_map(*[
        x for c, vs in plan.levels.items() for v in vs[1:]
        for x in (F.lit(f"nominal__{c}_{v}"), F.struct(F.lit(c).alias("variable"), F.lit(v).alias("level")))
    ])
    long = wide.unpivot(["encounter_id"], plan.names(), "name", "hot").withColumn("f", names[F.col("name")])
    return long.select("encounter_id", "f.variable", "f.level", "hot")


def _manifest_sql(columns="CAST(position AS INTEGER) AS position, feature", more=""):
    numeric = [f"SELECT {i} AS position, 'numeric__{c}' AS feature" for i, c in enumerate(R.NUMERIC_FEATURES)]
    n = len(numeric)
    ords = [("med_ord", m) for m in R.MODELLED_MEDICATIONS]
    ords += [("a1c_ord", "a1cresult"), ("glu_ord", "max_glu_serum")]
    fixed = numeric + [f"SELECT {n + i}, '{g}__{c}'" for i, (g, c) in enumerate(ords)]
    levels = " UNION ALL ".join(
        f"SELECT DISTINCT {i} AS o, '{c}' AS variable, {c} AS level FROM mart WHERE split_group = 'train' AND {c} IS NOT NULL"
        for i, c in enumerate(R.NOMINAL_FEATURES)
    )
    return with_steps(
        "mart",
        f"SELECT {columns} FROM ("
        + " UNION ALL ".join(fixed)
        + f" UNION ALL SELECT {len(fixed)} + ROW_NUMBER() OVER (ORDER BY o, level) - 1, 'nominal__' || variable || '_' || level FROM ("
        "SELECT *, ROW_NUMBER() OVER (PARTITION BY o ORDER BY level) AS i FROM lv) WHERE i > 1)" + more,
        lv=levels,
    )


@query("feature_manifest", _manifest_sql())
def _(spark, d):
    m = mart(spark, d)
    plan = fit_features(
        train(m), R.NUMERIC_FEATURES,
        K.ordinal_columns(R.MODELLED_MEDICATIONS, R.MEDICATION_ORDER, R.A1C_ORDER, R.GLUCOSE_ORDER), R.NOMINAL_FEATURES,
    )
    return plan.manifest(m)


_MATRICES: dict[tuple, K.Matrix] = {}
_MODELS: dict[tuple, Model] = {}
_HELD_OUT: dict[tuple, DataFrame] = {}


def data_state(spark, d) -> tuple:
    """The application, the directory and its tables as they stand: name, size and time of change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(d)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    tables = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)
    return (spark.sparkContext.applicationId, d, *tables)


def matrix(spark, d) -> K.Matrix:
    """The matrix of a data directory, built once per application and state of the data."""
    key = data_state(spark, d)
    if key not in _MATRICES:
        _MATRICES[key] = K.build_matrix(mart(spark, d))
    return _MATRICES[key]


def fitted(spark, d, name: str) -> Model:
    """A reported model, fitted once per application and state of the data."""
    key = (name, *data_state(spark, d))
    if key not in _MODELS:
        _MODELS[key] = K.TRAINERS[name](matrix(spark, d))
    return _MODELS[key]


def every_fitted(spark, d) -> dict[str, Model]:
    """All reported models by name, fitted side by side: each fit is a row of small jobs that wait more than they work."""
    matrix(spark, d)  # built before the fits, which share it
    names = list(K.TRAINERS)
    return dict(zip(names, M.in_parallel(spark, lambda name: fitted(spark, d, name), names, len(names))))


@query("lr_scores")
def _(spark, d):
    return K.score(fitted(spark, d, "logistic"), matrix(spark, d).rows)


@query("lr_metrics")
def _(spark, d):
    return K.report(K.score(fitted(spark, d, "logistic"), matrix(spark, d).rows))


@query("lr_coefficients")
def _(spark, d):
    return M.coefficient_rank(fitted(spark, d, "logistic"), matrix(spark, d).plan.names(), spark)


@query("lr_optimality", _manifest_sql("feature, TRUE AS optimal", " UNION ALL SELECT '(Intercept)', TRUE"))
def _(spark, d):
    # the fit against the conditions that only the penalised optimum meets
    x = matrix(spark, d)
    weighted, _ = M.prepare(x.split("train"), R.LABEL)
    found = M.optimality(fitted(spark, d, "logistic"), weighted, R.LABEL, "features", "class_weight", x.plan.names())
    return found.select("feature", (F.col("violation") < 1e-3).alias("optimal"))


@query("lr_search")
def _(spark, d):
    # every point of the grid, each by the mean AUC of five held-out folds
    x = matrix(spark, d)
    folded = cut_lineage(M.stratified_fold(x.split("train"), R.KEY, R.LABEL, 5))
    space = {"c": [0.001, 0.01, 0.1, 1.0], "l1_ratio": [0.0, 0.5, 1.0]}
    grid = M.random_grid(space, trials=math.prod(map(len, space.values())), seed=3)
    _, _, trials = M.search_cv(lambda p, rows: K.fit_logistic(rows, **p), grid, folded, "fold", 5, R.LABEL, workers=8, together=K.score_logistic_folds)
    return spark.createDataFrame([(p["c"], p["l1_ratio"], v) for p, v in trials], "c double, l1_ratio double, mean_auc double")


BOOSTED_SPACE = {
    "maxDepth": [3, 4, 5, 6], "stepSize": [0.03, 0.06, 0.12], "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.5", "0.75", "1.0"], "minInstancesPerNode": [4, 32, 128],
}
NETWORK_SPACE = {"hidden": [(16,), (32, 16), (64, 32), (128, 64, 32)], "seed": [7, 8, 9]}


def halving(spark, d, fit, space, trials, budgets):
    """Every rung of a search with the trials' settings."""
    x = matrix(spark, d)
    grid = M.random_grid(space, trials, seed=11)
    rungs = M.successive_halving(fit, grid, x.split("train"), x.split("validation"), R.LABEL, budgets, scratch_path(spark, "search"), workers=8)
    named = spark.createDataFrame([(i, str(sorted(p.items()))) for i, p in enumerate(grid)], "trial int, settings string")
    return rungs.join(named, "trial")


@query("gbt_search")
def _(spark, d):
    def fit(params, rows, trees):
        weighted, _ = M.prepare(rows, R.LABEL)
        return M.boosted_trees(R.LABEL, "features", maxIter=trees, seed=7, **params).fit(weighted)

    return halving(spark, d, fit, BOOSTED_SPACE, 12, [2, 4, 8])


@query("mlp_search")
def _(spark, d):
    width = len(matrix(spark, d).plan.names())

    def fit(params, rows, steps):
        return K.fit_perceptron(rows, width, maxIter=steps, **params)

    return halving(spark, d, fit, NETWORK_SPACE, 8, [5, 10, 20])


@query("gbt_scores")
def _(spark, d):
    return K.score(fitted(spark, d, "boosted"), matrix(spark, d).rows)


@query("gbt_early_stopping")
def _(spark, d):
    x = matrix(spark, d)
    return K.report(K.score(K.train_boosted_stopping(x), x.rows))


@query("gbt_deep_scores")
def _(spark, d):
    return K.score(fitted(spark, d, "boosted_deep"), matrix(spark, d).rows)


@query("mlp_scores")
def _(spark, d):
    return K.score(fitted(spark, d, "perceptron"), matrix(spark, d).rows)


@query(
    "stratified_folds",
    with_steps(
        "mart",
        "SELECT encounter_id, readmitted_30day, CAST((ROW_NUMBER() OVER (PARTITION BY readmitted_30day "
        "ORDER BY substr(md5(encounter_id || ':0'), 1, 15)) - 1) % 5 AS INTEGER) AS fold FROM mart WHERE split_group = 'train'",
    ),
)
def _(spark, d):
    return M.stratified_fold(train(mart(spark, d, R.LABEL)), "encounter_id", R.LABEL, 5).select("encounter_id", R.LABEL, "fold")


@query("platt_calibrated")
def _(spark, d):
    x = matrix(spark, d)
    ensemble = M.platt_ensemble(K.fit_logistic, x.split("train"), R.KEY, R.LABEL)
    return ensemble.transform(x.rows).select(*K.KEEP, "prob")


@query("platt_boosted")
def _(spark, d):
    # both boosted models at their reported sizes, each a mean of five fold models behind their own sigmoids
    x = matrix(spark, d)
    parts = []
    for name, fit in (("boosted", K.fit_boosted), ("boosted_deep", K.fit_boosted_deep)):
        ensemble = M.platt_ensemble(fit, x.split("train"), R.KEY, R.LABEL)
        parts.append(ensemble.transform(x.rows).select(F.lit(name).alias("model"), *K.KEEP, "prob"))
    return reduce(DataFrame.unionByName, parts)


def network_out_of_fold(spark, d):
    """Training rows scored by the network that did not see their fold, stored; fitted once per state of the data."""
    key = data_state(spark, d)
    if key not in _HELD_OUT:
        x = matrix(spark, d)
        width = len(x.plan.names())
        scored = M.out_of_fold_together(lambda rows: K.fit_perceptron_folds(rows, width), x.split("train"), R.KEY, R.LABEL)
        _HELD_OUT[key] = materialize(scored.select(*K.KEEP, "prob"), "network-held-out")
    return _HELD_OUT[key]


@query("isotonic_network")
def _(spark, d):
    x = matrix(spark, d)
    fits = [lambda: network_out_of_fold(spark, d), lambda: fitted(spark, d, "perceptron")]
    held_out, model = M.in_parallel(spark, lambda fit: fit(), fits, len(fits))
    return apply_blocks(isotonic_blocks(held_out, "prob", R.LABEL), K.score(model, x.rows), "prob")


@query(
    "isotonic_network_totals",
    with_steps(
        "mart",
        "SELECT COUNT(*) AS n, CAST(SUM(readmitted_30day) AS BIGINT) AS positives, ROUND(AVG(readmitted_30day), 6) AS mean_calibrated, "
        "TRUE AS ordered FROM mart WHERE split_group = 'train'",
    ),
)
def _(spark, d):
    # a monotone least-squares fit keeps the mean of what it is fitted to
    held_out = network_out_of_fold(spark, d)
    blocks = cut_lineage(isotonic_blocks(held_out, "prob", R.LABEL))
    following = F.lead("value").over(Window.partitionBy(F.lit(1)).orderBy("lo"))  # a row per block
    falls = blocks.select((following <= F.col("value")).alias("falls")).agg(F.count_if("falls") == 0).scalar()
    return apply_blocks(blocks, held_out, "prob", "calibrated").agg(
        F.count("*").alias("n"),
        F.sum(R.LABEL).alias("positives"),
        F.round(F.avg("calibrated"), 6).alias("mean_calibrated"),
    ).withColumn("ordered", falls)


@query("isotonic_calibrated")
def _(spark, d):
    x = matrix(spark, d)
    held_out = materialize(M.out_of_fold(K.fit_logistic, x.split("train"), R.KEY, R.LABEL), "held-out")
    return apply_blocks(isotonic_blocks(held_out, "prob", R.LABEL), K.score(fitted(spark, d, "logistic"), x.rows), "prob")


# the monotone fit by its definition: the greatest least average over the stretches around a point
_ISOTONIC = {
    "pt": "SELECT prob AS s, COUNT(*) AS n, SUM(readmitted_30day) AS p, ROW_NUMBER() OVER (ORDER BY prob) AS i FROM mart WHERE split_group = 'train' GROUP BY prob",
    "cu": "SELECT *, SUM(n) OVER (ORDER BY i) AS cn, SUM(p) OVER (ORDER BY i) AS cp FROM pt",
    "av": "SELECT a.i AS a, b.i AS b, (b.cp - a.cp + a.p) / (b.cn - a.cn + a.n) AS v FROM cu a JOIN cu b ON a.i <= b.i",
    "mn": "SELECT a, b, MIN(v) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM av",
    "ft": "SELECT s, v FROM (SELECT b, MAX(m) AS v FROM mn GROUP BY b) JOIN pt ON i = b",
    "bl": "SELECT MIN(s) AS lo, MAX(s) AS hi, v FROM ft GROUP BY v",
    "bn": "SELECT *, LEAD(lo) OVER (ORDER BY lo) AS nl, LEAD(v) OVER (ORDER BY lo) AS nv FROM bl",
}


@query("isotonic_blocks", with_steps("mart", "SELECT lo, hi, ROUND(v, 6) AS value FROM bl", **_ISOTONIC))
def _(spark, d):
    return rounded(isotonic_blocks(train(mart(spark, d, R.LABEL, "prob")), "prob", R.LABEL).select("lo", "hi", "value"), "value")


@query(
    "isotonic_applied",
    with_steps(
        "mart",
        "SELECT m.encounter_id, ROUND(CASE WHEN b.v IS NULL THEN (SELECT v FROM bl ORDER BY lo LIMIT 1) WHEN nl IS NULL OR prob <= hi THEN b.v "
        "ELSE b.v + (nv - b.v) * (prob - hi) / (nl - hi) END, 6) AS calibrated FROM (SELECT * FROM mart WHERE split_group <> 'train') m ASOF LEFT JOIN bn b ON m.prob >= b.lo",
        **_ISOTONIC,
    ),
)
def _(spark, d):
    m = mart(spark, d, R.LABEL, "prob")
    out = apply_blocks(isotonic_blocks(train(m), "prob", R.LABEL), m.where("split_group <> 'train'"), "prob", "calibrated")
    return rounded(out.select("encounter_id", "calibrated"), "calibrated")


@query("permutation_importance")
def _(spark, d):
    x = matrix(spark, d)
    return M.permutation_importance(fitted(spark, d, "boosted"), x.split("validation"), R.KEY, R.LABEL, "features", x.plan.names())


@query(
    "tree_path_margins",
    with_steps("mart", "SELECT encounter_id, TRUE AS adds_up FROM mart WHERE split_group = 'validation'"),
)
def _(spark, d):
    # a row's contributions and the roots' values add up to the model's margin
    x = matrix(spark, d)
    model = fitted(spark, d, "boosted")
    margin = vector_to_array("rawPrediction")[1].alias("margin")
    rows = model.transform(x.split("validation")).select(R.KEY, "features", margin)
    added = path_contributions(model, rows, "features", len(x.plan.names()), [R.KEY, "margin"])
    total = F.aggregate("contributions", F.col("base"), lambda a, v: a + v)
    return added.select(R.KEY, (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up"))


@query("tree_attribution")
def _(spark, d):
    return K.attribution("boosted", fitted(spark, d, "boosted"), matrix(spark, d)).select("feature", F.col("value").alias("mean_abs"))


@query(
    "network_path_scores",
    with_steps("mart", "SELECT encounter_id, TRUE AS adds_up FROM mart WHERE split_group = 'validation'"),
)
def _(spark, d):
    # a row's contributions and the baseline's probability add up to the model's own probability
    model = fitted(spark, d, "perceptron")
    rows = M.positive_probability(model, matrix(spark, d).split("validation"))
    added = gradient_contributions(model, rows, "features", [R.KEY, "prob"])
    total = F.aggregate("contributions", F.col("base"), lambda a, v: a + v)
    return added.select(R.KEY, (F.abs(total - F.col("prob")) < 1e-4).alias("adds_up"))


@query("network_attribution")
def _(spark, d):
    x = matrix(spark, d)
    found = gradient_attribution(fitted(spark, d, "perceptron"), x.split("validation"), "features", x.plan.names())
    return found.select("feature", "mean_abs")


@query("linear_attribution")
def _(spark, d):
    return K.attribution("logistic", fitted(spark, d, "logistic"), matrix(spark, d)).select("feature", F.col("value").alias("mean_abs"))


# --- the fitted models compared -----------------------------------------------


def model_scores(spark, d):
    """(encounter, model) to score and label, stored: every comparison reads it."""
    x = matrix(spark, d)
    parts = [K.score(model, x.rows).withColumn("model", F.lit(name)) for name, model in every_fitted(spark, d).items()]
    return materialize(reduce(DataFrame.unionByName, parts), "model-scores")


@query("fitted_model_gap")
def _(spark, d):
    scores = model_scores(spark, d).select("model", R.SPLIT, F.col(R.LABEL).alias("y"), F.col("prob").alias("p"))
    return compare_models(scores, R.DEPLOYED_TAU)


@query("fitted_rank_compare")
def _(spark, d):
    x = matrix(spark, d)
    parts = [K.attribution(name, model, x) for name, model in every_fitted(spark, d).items()]
    ranked = E.rank_features(materialize(reduce(DataFrame.unionByName, parts), "attributions"), "model", "feature", "value")
    return E.compare_ranks(ranked, "model", "feature", list(K.TRAINERS), "boosted", 10, len(x.plan.names()) + 1)


# Directions that the effect estimates and clinical knowledge suggest.
DIRECTIONS = [
    ("numeric__number_inpatient", 1), ("numeric__time_in_hospital", 1), ("a1c_ord__a1cresult", -1), ("med_ord__insulin", 1),
    ("nominal__diag_1_group_Respiratory", -1), ("med_ord__metformin", -1),
]


@query("fitted_direction_check")
def _(spark, d):
    coefficients = M.coefficient_rank(fitted(spark, d, "logistic"), matrix(spark, d).plan.names(), spark)
    expected = spark.createDataFrame(DIRECTIONS, "feature string, expected_sign int")
    return E.direction_check(expected, coefficients.select("feature", "coefficient"), "feature")


# --- streaming ----------------------------------------------------------------

REQUEST_COLUMNS = ["encounter_id", "age_midpoint", "time_in_hospital", "number_inpatient", "insulin", "race"]
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("age_midpoint", T.IntegerType()),
        T.StructField("time_in_hospital", T.IntegerType()),
        T.StructField("number_inpatient", T.IntegerType()),
        T.StructField("insulin", T.StringType()),
        T.StructField("race", T.StringType()),
    ]
)


def small_model(spark, d):
    """A saved and reloaded feature-and-logistic model on the request columns."""
    m = mart(spark, d, R.LABEL, *[c for c in REQUEST_COLUMNS if c != R.KEY])
    plan = fit_features(
        train(m), ["age_midpoint", "time_in_hospital", "number_inpatient"],
        [("med_ord", "insulin", R.MEDICATION_ORDER)], ["race"],
    )
    rows, total = M.prepare(train(m), R.LABEL)
    fitted = Pipeline(stages=[*plan.stages(), M.logistic(R.LABEL, "features", 1.0, 0.0, total)]).fit(rows)
    path = scratch_path(spark, "model")
    fitted.write().overwrite().save(path)
    return m.where("split_group = 'holdout'"), PipelineModel.load(path)


@query("stream_scores")
def _(spark, d):
    holdout, model = small_model(spark, d)
    inbox = scratch_path(spark, "requests")
    to_requests(holdout, REQUEST_COLUMNS, F.expr("encounter_id div 16")).select("payload").write.text(inbox)
    stream = S.score_requests(S.read_requests(spark, inbox), REQUEST_SCHEMA, model, R.DEPLOYED_TAU, keep=["encounter_id"])
    sink = scratch_path(spark, "predictions")
    S.run_available(stream, scratch_path(spark, "progress"), sink)
    return spark.read.parquet(sink)


def event_stream(spark, d):
    schema = table(spark, d, "events").schema
    # a glob reads one file and a folder of files alike
    return spark.readStream.schema(schema).parquet(d.rstrip("/") + "/events.parque[t]")


@query(
    "stream_window_totals",
    "SELECT CAST(FLOOR(epoch(ts) / 604800) * 604800 AS BIGINT) AS window_start, event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM events GROUP BY 1, 2",
)
def _(spark, d):
    totals = S.window_totals(event_stream(spark, d), "ts", "7 days", "1 day", "event_type", "value")
    sink = scratch_path(spark, "totals")
    S.run_updates(totals, scratch_path(spark, "progress"), sink)
    out = S.latest(spark, sink, ["window_start", "event_type"], ["n", "total"])
    return rounded(out.withColumn("window_start", F.unix_timestamp("window_start")), "total")


_EVENT_PSI = {
    "rf": "SELECT value, length(props) AS props_length FROM events WHERE ts < TIMESTAMP '2024-01-11'",
    "cu": "SELECT CAST(FLOOR(epoch(ts) / 604800) * 604800 AS BIGINT) AS w, value, length(props) AS props_length FROM events",
    **psi_steps("rf", "cu", "w", ["value", "props_length"]),
}


@query(
    "stream_drift",
    "WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in _EVENT_PSI.items())
    + " SELECT period AS window_start, feature, ROUND(psi, 6) AS psi, degenerate FROM ps",
)
def _(spark, d):
    # reference: the first ten days; the stream keeps counts per window and bin
    events = table(spark, d, "events").withColumn("props_length", F.length("props"))
    first = events.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-11 00:00:00")))
    fitted = fit_psi_reference(first, ["value", "props_length"])
    stream = event_stream(spark, d).withColumn("props_length", F.length("props"))
    counts = S.window_cell_counts(stream, "ts", "7 days", "1 day", fitted)
    sink = scratch_path(spark, "cells")
    S.run_updates(counts, scratch_path(spark, "progress"), sink)
    state = S.latest(spark, sink, ["window_start", "feature", "cell"], ["c"])
    state = state.withColumn("window_start", F.unix_timestamp("window_start"))
    return rounded(psi_from_counts(fitted, state, "window_start"), "psi")


_WINDOW_REPORT = {
    "tr": "SELECT value AS prob, value, length(props) AS props_length FROM events WHERE ts < TIMESTAMP '2024-01-11'",
    "ho": "SELECT CAST(FLOOR(epoch(ts) / 604800) * 604800 AS BIGINT) AS batch, value AS prob, value, length(props) AS props_length, "
    "CAST(event_type = 'purchase' AS INTEGER) AS y FROM events",
    **psi_steps("tr", "ho", "batch", ["value", "props_length"]),
    **SQL_KS,
    "au": "SELECT batch, COUNT(*) AS n, AVG(CASE WHEN prob >= 75 THEN 1 ELSE 0 END) AS flag_rate, AVG(y) AS pos_rate, SUM(y) AS n1, SUM(1 - y) AS n0, "
    "COALESCE(SUM(r) FILTER (WHERE y = 1), 0) AS r1 FROM (SELECT *, RANK() OVER (PARTITION BY batch ORDER BY prob) "
    "+ (COUNT(*) OVER (PARTITION BY batch, prob) - 1) / 2.0 AS r FROM ho) GROUP BY 1",
    "mp": "SELECT period AS batch, AVG(psi) AS mean_psi FROM ps GROUP BY 1",
}


@query(
    "stream_drift_reports",
    "WITH " + ", ".join(f"{n} AS MATERIALIZED ({q})" for n, q in _WINDOW_REPORT.items())
    + " SELECT batch AS window_start, au.n AS n_rows, ROUND(CASE WHEN n1 > 0 AND n0 > 0 THEN (r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0) END, 6) AS auc_roc, "
    "ROUND(flag_rate, 6) AS flag_rate, ROUND(pos_rate, 6) AS pos_rate, ROUND(d, 6) AS ks_stat, ROUND(p, 6) AS ks_pval, ROUND(mean_psi, 6) AS mean_psi, "
    "mean_psi > 0.20 OR d > 0.10 AS drift_alert FROM au JOIN kp USING (batch) JOIN mp USING (batch)",
)
def _(spark, d):
    # the stream keeps counts per window; the reference, its first ten days, is counted once
    events = table(spark, d, "events").withColumn("props_length", F.length("props"))
    first = events.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-11 00:00:00")))
    reference = SW.fit_reference(first, "value", ["value", "props_length"])
    stream = event_stream(spark, d).withColumns({"props_length": F.length("props"), "y": (F.col("event_type") == "purchase").cast("int")})
    sink = scratch_path(spark, "window-counts")
    SW.run_window_counts(SW.window_counts(stream, "ts", "7 days", "1 day", "value", "y", reference), scratch_path(spark, "progress"), sink)
    out = SW.window_reports(spark, sink, reference, 75.0).drop("psi_by_feature")
    out = out.withColumn("window_start", F.unix_timestamp("window_start"))
    return rounded(out, "auc_roc", "flag_rate", "pos_rate", "ks_stat", "ks_pval", "mean_psi")
