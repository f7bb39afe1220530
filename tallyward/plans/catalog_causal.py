"""Catalog: treatment effects and experiment design."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions.scalar import flag
from tallyward.operators import bootstrap as B
from tallyward.operators import causal as C
from tallyward.operators import design as X
from tallyward.operators import matching as M
from tallyward.operators.ordered_matching import match_in_order
from tallyward.operators.evaluate import threshold_sweep
from tallyward.operators.features import category_levels
from tallyward.plans import encounter_rules as R
from tallyward.plans.catalog_base import Catalog, features, mart, rounded, sql_normal_upper, staged, with_steps
from tallyward.session import materialize

catalog = Catalog()
query = catalog.query

# treatment "lab tested"; its propensity is the treated share of the stratum,
# strata without both arms left out
SQL_TREATED = {
    "t0": "SELECT encounter_id, age_group, admission_type_group, readmitted_30day AS y, prob, num_medications, time_in_hospital, number_diagnoses, race, gender, "
    "CASE WHEN a1cresult <> 'None' THEN 1 ELSE 0 END AS a FROM features",
    "st": "SELECT age_group, admission_type_group, AVG(a) AS ps FROM t0 GROUP BY 1, 2",
    "tr": "SELECT t0.*, ps FROM t0 JOIN st USING (age_group, admission_type_group) WHERE ps > 0 AND ps < 1",
    "wt": "SELECT *, CASE WHEN a = 1 THEN (SELECT AVG(a) FROM tr) / ps ELSE (1 - (SELECT AVG(a) FROM tr)) / (1 - ps) END AS iptw FROM tr",
}


def treated(spark, d):
    base = features(spark, d).select(
        "encounter_id", "age_group", "admission_type_group", F.col(R.LABEL).alias("y"), "prob", "num_medications",
        "time_in_hospital", "number_diagnoses", "race", "gender", flag(F.col("a1cresult") != "None").alias("a"),
    )
    # both groupings take their values from short lists in encounter_rules, so
    # the shares fit one map; no row is shuffled onto the few strata
    stratum = F.concat("age_group", F.lit("|"), "admission_type_group")
    strata = base.groupBy(stratum.alias("stratum")).agg(F.avg("a").alias("ps")).where("stratum IS NOT NULL")
    shares = strata.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "ps"))).alias("m")).scalar()
    return base.withColumn("ps", F.try_element_at(shares, stratum)).where("ps > 0 AND ps < 1")


def weighted(spark, d):
    return C.stabilised_weights(treated(spark, d), "a", "ps")


@query("iptw_weights", with_steps("features", "SELECT encounter_id, a, ROUND(ps, 6) AS ps, ROUND(iptw, 6) AS iptw FROM wt", **SQL_TREATED))
def _(spark, d):
    return rounded(weighted(spark, d).select("encounter_id", "a", "ps", "iptw"), "ps", "iptw")


@query(
    "ess",
    with_steps(
        "features",
        "SELECT a, COUNT(*) AS n, ROUND(MIN(iptw), 6) AS min_weight, ROUND(MAX(iptw), 6) AS max_weight, "
        "ROUND(SUM(iptw) * SUM(iptw) / SUM(iptw * iptw), 6) AS ess FROM wt GROUP BY 1",
        **SQL_TREATED,
    ),
)
def _(spark, d):
    return rounded(C.weight_summary(weighted(spark, d), "a", "iptw"), "min_weight", "max_weight", "ess")


BALANCE_NUMERIC = ["num_medications", "time_in_hospital", "number_diagnoses"]
BALANCE_LEVELS = {"race": ["AfricanAmerican", "Asian", "Caucasian", "Hispanic", "Other"], "gender": ["Female", "Male"]}
_DUMMIES = [(f"{c}_{v}", f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END") for c, vs in BALANCE_LEVELS.items() for v in vs]
_ALL = [(c, f"CAST({c} AS DOUBLE)") for c in BALANCE_NUMERIC] + _DUMMIES
SQL_BAL_LONG = " UNION ALL ".join(f"SELECT '{n}' AS covariate, CAST({e} AS DOUBLE) AS x, a, iptw AS w FROM wt" for n, e in _ALL)
SQL_BALANCE = {
    **SQL_TREATED,
    "bl": SQL_BAL_LONG,
    "bm": "SELECT covariate, AVG(x) FILTER (WHERE a = 1) - AVG(x) FILTER (WHERE a = 0) AS diff, "
    "SUM(w * x) FILTER (WHERE a = 1) / SUM(w) FILTER (WHERE a = 1) - SUM(w * x) FILTER (WHERE a = 0) / SUM(w) FILTER (WHERE a = 0) AS diff_w, "
    "SQRT((var_samp(x) FILTER (WHERE a = 1) + var_samp(x) FILTER (WHERE a = 0)) / 2) AS sd FROM bl GROUP BY 1",
    "bv": "SELECT covariate, x, SUM(a) AS n1, SUM(1 - a) AS n0, SUM(w * a) AS w1, SUM(w * (1 - a)) AS w0 FROM bl GROUP BY 1, 2",
    "bc": "SELECT covariate, SUM(n1) OVER u / SUM(n1) OVER v - SUM(n0) OVER u / SUM(n0) OVER v AS g, SUM(w1) OVER u / SUM(w1) OVER v - SUM(w0) OVER u / SUM(w0) OVER v AS gw "
    "FROM bv WINDOW u AS (PARTITION BY covariate ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), v AS (PARTITION BY covariate)",
    "bk": "SELECT covariate, MAX(ABS(g)) AS ks, MAX(ABS(gw)) AS ks_weighted FROM bc GROUP BY 1",
    "bs": f"SELECT covariate, CASE WHEN covariate IN ({', '.join(repr(n) for n, _ in _DUMMIES)}) THEN 1.0 ELSE sd END AS s, diff, diff_w, ks, ks_weighted FROM bm JOIN bk USING (covariate)",
}


def balance(spark, d):
    return C.balance(weighted(spark, d), "a", BALANCE_NUMERIC, BALANCE_LEVELS, "iptw")


@query(
    "balance_smd",
    with_steps(
        "features",
        "SELECT covariate, ROUND(diff / s, 6) AS smd, ROUND(diff_w / s, 6) AS smd_weighted, ABS(diff_w / s) <= 0.1 AS balanced FROM bs",
        **SQL_BALANCE,
    ),
)
def _(spark, d):
    return rounded(balance(spark, d).select("covariate", "smd", "smd_weighted", "balanced"), "smd", "smd_weighted")


@query(
    "balance_ks",
    with_steps("features", "SELECT covariate, ROUND(ks, 6) AS ks, ROUND(ks_weighted, 6) AS ks_weighted FROM bs", **SQL_BALANCE),
)
def _(spark, d):
    return rounded(balance(spark, d).select("covariate", "ks", "ks_weighted"), "ks", "ks_weighted")


SQL_OR = {
    **SQL_TREATED,
    "os": "SELECT COUNT(*) AS n, SUM(iptw) FILTER (WHERE a = 1) AS w1, SUM(iptw) FILTER (WHERE a = 0) AS w0, "
    "SUM(iptw * y) FILTER (WHERE a = 1) / SUM(iptw) FILTER (WHERE a = 1) AS p1, SUM(iptw * y) FILTER (WHERE a = 0) / SUM(iptw) FILTER (WHERE a = 0) AS p0 FROM wt",
    "ol": "SELECT n, LN(p1 / (1 - p1)) - LN(p0 / (1 - p0)) AS lo, SQRT((w1 + w0) / (n - 2) * (1 / (w1 * p1 * (1 - p1)) + 1 / (w0 * p0 * (1 - p0)))) AS se FROM os",
    "oz": "SELECT *, lo / se AS t, ABS(lo / se * (1 - 1 / (4 * (n - 2))) / SQRT(1 + lo / se * lo / se / (2 * (n - 2)))) AS z FROM ol",
}


@query(
    "weighted_or",
    with_steps(
        "features",
        f"SELECT n, ROUND(EXP(lo), 6) AS odds_ratio, ROUND(se, 6) AS std_error, ROUND(t, 6) AS statistic, ROUND(2 * {sql_normal_upper('z')}, 6) AS p_value, "
        "ROUND(EXP(lo - 1.959963984540054 * se), 6) AS wald_low, ROUND(EXP(lo + 1.959963984540054 * se), 6) AS wald_high FROM oz",
        **SQL_OR,
    ),
)
def _(spark, d):
    out = C.weighted_odds_ratio(weighted(spark, d), "a", "y", "iptw")
    return rounded(out, "odds_ratio", "std_error", "statistic", "p_value", "wald_low", "wald_high")


@query(
    "e_value",
    with_steps(
        "features",
        "SELECT ROUND(r, 6) AS odds_ratio, ROUND(GREATEST(r, 1 / r) + SQRT(GREATEST(r, 1 / r) * (GREATEST(r, 1 / r) - 1)), 6) AS e_value FROM (SELECT EXP(lo) AS r FROM oz)",
        **SQL_OR,
    ),
)
def _(spark, d):
    ratio = C.weighted_odds_ratio(weighted(spark, d), "a", "y", "iptw").select("odds_ratio")
    return rounded(C.with_e_value(ratio, "odds_ratio"), "odds_ratio", "e_value")


@query(
    "aipw_given_models",
    with_steps(
        "features",
        "SELECT ROUND(m1, 6) AS mean_1, ROUND(m0, 6) AS mean_0, ROUND(m1 - m0, 6) AS risk_difference, ROUND(m1 / m0, 6) AS risk_ratio FROM ("
        "SELECT AVG(q1 + a / ps * (y - q1)) AS m1, AVG(q0 + (1 - a) / (1 - ps) * (y - q0)) AS m0 FROM (SELECT *, LEAST(prob * 1.2, 1.0) AS q1, prob AS q0 FROM tr))",
        **SQL_TREATED,
    ),
)
def _(spark, d):
    df = treated(spark, d).withColumns({"q1": F.least(F.col("prob") * 1.2, F.lit(1.0)), "q0": F.col("prob")})
    return rounded(C.aipw(df, "a", "y", "ps", "q1", "q0"), "mean_1", "mean_0", "risk_difference", "risk_ratio")


PS_COVARIATES = ["age_midpoint", "admission_type_group", "num_medications", "number_diagnoses", "race", "gender"]


def train_rows(spark, d):
    m = mart(spark, d, R.LABEL, "number_inpatient", "time_in_hospital", "a1cresult", "insulin", *PS_COVARIATES)
    return m.where("split_group = 'train'").select(
        "encounter_id", F.col(R.LABEL).alias("y"), "number_inpatient", "time_in_hospital",
        flag(F.col("a1cresult") != "None").alias("tested"),
        flag(F.col("insulin").isin("Up", "Down")).alias("adjusted"),
        flag(F.col("number_inpatient") > 0).alias("prior"),
        *PS_COVARIATES,
    )


@query("propensity_fit")
def _(spark, d):
    return C.propensity(train_rows(spark, d), "tested", PS_COVARIATES).select("encounter_id", "tested", "ps")


_SUMMED = ["age_midpoint", "num_medications", "number_diagnoses"]
_LEVELLED = ["admission_type_group", "race", "gender"]


@query(
    "propensity_sums",
    with_steps(
        "mart",
        "SELECT covariate, level, CAST(SUM(x) AS BIGINT) AS total, CAST(SUM(x * tested) AS BIGINT) AS treated, ROUND(SUM(x * tested), 2) AS expected "
        "FROM op GROUP BY covariate, level",
        cv="SELECT *, CASE WHEN a1cresult <> 'None' THEN 1 ELSE 0 END AS tested FROM mart WHERE split_group = 'train' AND "
        + " AND ".join(f"{c} IS NOT NULL" for c in PS_COVARIATES),
        op=" UNION ALL ".join(
            [f"SELECT '{c}' AS covariate, {c} AS level, 1.0::DOUBLE AS x, tested FROM cv" for c in _LEVELLED]
            + [f"SELECT '{c}', 'sum', CAST({c} AS DOUBLE), tested FROM cv" for c in _SUMMED]
        ),
    ),
)
def _(spark, d):
    # at the maximum of the likelihood the fitted chances add up to the treated
    # rows, in every level and weighted by every number
    df = C.propensity(train_rows(spark, d), "tested", PS_COVARIATES)
    opened = df.select("tested", "ps", F.inline(F.array(
        *[F.struct(F.lit(c).alias("covariate"), F.col(c).alias("level"), F.lit(1.0).alias("x")) for c in _LEVELLED],
        *[F.struct(F.lit(c).alias("covariate"), F.lit("sum").alias("level"), F.col(c).cast("double").alias("x")) for c in _SUMMED],
    )))
    return opened.groupBy("covariate", "level").agg(
        F.sum("x").cast("long").alias("total"),
        F.sum(F.col("x") * F.col("tested")).cast("long").alias("treated"),
        F.round(F.sum(F.col("x") * F.col("ps")), 2).alias("expected"),
    )


@query("propensity_coefficients")
def _(spark, d):
    return C.coefficient_table(C.fit_logit(train_rows(spark, d), "tested", PS_COVARIATES))


def matched(spark, d):
    df = C.propensity(train_rows(spark, d), "adjusted", PS_COVARIATES)
    return df, match_in_order(df, "encounter_id", "adjusted", "ps")


@query("psm_pairs")
def _(spark, d):
    return matched(spark, d)[1]


@query(
    "psm_equal_scores",
    with_steps(
        "features",
        "SELECT t.encounter_id AS treated, c.encounter_id AS control, 0.0::DOUBLE AS distance FROM r t JOIN r c ON t.prob = c.prob AND t.k = c.k WHERE t.a = 1 AND c.a = 0",
        r="SELECT *, ROW_NUMBER() OVER (PARTITION BY prob, a ORDER BY encounter_id) AS k FROM "
        "(SELECT encounter_id, prob, CASE WHEN insulin IN ('Up', 'Down') THEN 1 ELSE 0 END AS a FROM features)",
    ),
)
def _(spark, d):
    # caliper 0: only equal scores pair, which SQL can say with row numbers
    df = features(spark, d).select("encounter_id", "prob", flag(F.col("insulin").isin("Up", "Down")).alias("a"))
    return M.match_pairs(df, "encounter_id", "a", "prob", caliper_sd=0.0)


# whole-number scores: a step of the recursion takes one treated level's rows to the nearest control level left
_IN_ORDER = {
    "r": "SELECT *, ROW_NUMBER() OVER (PARTITION BY a, s ORDER BY encounter_id) - 1 AS k FROM (SELECT encounter_id, CAST(ROUND(prob * 100) AS DOUBLE) AS s, "
    "CASE WHEN insulin IN ('Up', 'Down') THEN 1 ELSE 0 END AS a FROM features)",
    "lim": "SELECT 0.3 * stddev_samp(s) AS lim FROM r",
    "tl": "SELECT s, ROW_NUMBER() OVER (ORDER BY s DESC) AS i, COUNT(*) AS n FROM r WHERE a = 1 GROUP BY s",
    "cl": "SELECT list(s ORDER BY s) AS cs, list(n ORDER BY s) AS cn FROM (SELECT s, COUNT(*) AS n FROM r WHERE a = 0 GROUP BY s)",
    "st": "SELECT 0 AS step, CAST(1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS done, cn AS rest, NULL::DOUBLE AS t, NULL::DOUBLE AS c, CAST(0 AS BIGINT) AS rank_t, "
    "CAST(0 AS BIGINT) AS rank_c, CAST(0 AS BIGINT) AS m FROM cl "
    "UNION ALL SELECT step + 1, CASE WHEN p IS NULL OR done + take = n THEN i + 1 ELSE i END, CASE WHEN p IS NULL OR done + take = n THEN 0 ELSE done + take END, "
    "CASE WHEN p IS NULL THEN rest ELSE list_transform(rest, lambda x, j: CASE WHEN j = p THEN x - take ELSE x END) END, s, CASE WHEN p IS NULL THEN NULL ELSE cs[p] END, "
    "done, CASE WHEN p IS NULL THEN 0 ELSE cn[p] - rest[p] END, CASE WHEN p IS NULL THEN 0 ELSE take END FROM ("
    "SELECT *, CASE WHEN p IS NOT NULL THEN LEAST(n - done, rest[p]) END AS take FROM ("
    "SELECT st.step, st.i, st.done, st.rest, tl.s, tl.n, cs, cn, list_sort(list_filter(list_transform(range(1, len(cs) + 1), "
    "lambda j: {'d': ABS(cs[j] - tl.s), 'c': cs[j], 'j': j, 'l': rest[j]}), lambda x: x.l > 0 AND x.d <= lim))[1].j AS p "
    "FROM st JOIN tl ON tl.i = st.i, cl, lim))",
    "sg": "SELECT t, c, rank_t + g AS kt, rank_c + g AS kc FROM (SELECT *, UNNEST(range(m)) AS g FROM st WHERE m > 0)",
}


@query(
    "psm_score_order",
    with_steps(
        "features",
        "SELECT x.encounter_id AS treated, y.encounter_id AS control, ABS(sg.t - sg.c) AS distance FROM sg JOIN r x ON x.a = 1 AND x.s = sg.t AND x.k = sg.kt "
        "JOIN r y ON y.a = 0 AND y.s = sg.c AND y.k = sg.kc",
        **_IN_ORDER,
    ).replace("WITH ", "WITH RECURSIVE ", 1).replace("st AS MATERIALIZED (", "st AS (", 1),
)
def _(spark, d):
    # the largest score first on a coarse score, three tenths of its deviation wide
    df = features(spark, d).select(
        "encounter_id", F.round(F.col("prob") * 100).alias("s"), flag(F.col("insulin").isin("Up", "Down")).alias("a")
    )
    return match_in_order(df, "encounter_id", "a", "s", caliper_sd=0.3)


_PAIRS = {
    **_IN_ORDER,
    "pr": "SELECT x.encounter_id AS treated, y.encounter_id AS control FROM sg JOIN r x ON x.a = 1 AND x.s = sg.t AND x.k = sg.kt "
    "JOIN r y ON y.a = 0 AND y.s = sg.c AND y.k = sg.kc",
    "mt": "SELECT f.*, 1 AS arm FROM features f JOIN pr ON f.encounter_id = pr.treated UNION ALL SELECT f.*, 0 FROM features f JOIN pr ON f.encounter_id = pr.control",
}


def _recursive(body: str) -> str:
    return with_steps("features", body, **_PAIRS).replace("WITH ", "WITH RECURSIVE ", 1).replace("st AS MATERIALIZED (", "st AS (", 1)


def matched_in_order(spark, d):
    df = features(spark, d).select(
        "encounter_id", F.round(F.col("prob") * 100).alias("s"), flag(F.col("insulin").isin("Up", "Down")).alias("a"),
        F.col(R.LABEL).alias("y"), "num_medications", "number_diagnoses",
    )
    return df, match_in_order(df, "encounter_id", "a", "s", caliper_sd=0.3)


@query(
    "psm_order_counts",
    _recursive(
        "SELECT a, COUNT(*) AS n_before, (SELECT COUNT(*) FROM pr) AS n_after FROM "
        "(SELECT CASE WHEN insulin IN ('Up', 'Down') THEN 1 ELSE 0 END AS a FROM features) GROUP BY 1"
    ),
)
def _(spark, d):
    df, pairs = matched_in_order(spark, d)
    return M.match_counts(df, "a", pairs)


@query(
    "psm_order_odds",
    _recursive(
        "SELECT ROUND((SUM(CASE WHEN arm = 1 THEN y END) / SUM(CASE WHEN arm = 1 THEN 1 - y END)) / (SUM(CASE WHEN arm = 0 THEN y END) / SUM(CASE WHEN arm = 0 THEN 1 - y END)), 6) AS odds_ratio, "
        "ROUND(AVG(CASE WHEN arm = 1 THEN num_medications END) - AVG(CASE WHEN arm = 0 THEN num_medications END), 6) AS medications_apart, "
        "ROUND(AVG(CASE WHEN arm = 1 THEN number_diagnoses END) - AVG(CASE WHEN arm = 0 THEN number_diagnoses END), 6) AS diagnoses_apart "
        "FROM (SELECT *, readmitted_30day AS y FROM mt)"
    ),
)
def _(spark, d):
    df, pairs = matched_in_order(spark, d)
    rows = materialize(M.matched_rows(df, "encounter_id", pairs), "matched")
    apart = [
        F.round(F.avg(F.when(F.col("a") == 1, F.col(c))) - F.avg(F.when(F.col("a") == 0, F.col(c))), 6).alias(n)
        for c, n in (("num_medications", "medications_apart"), ("number_diagnoses", "diagnoses_apart"))
    ]
    ratio = C.weighted_odds_ratio(rows, "a", "y").select(F.round("odds_ratio", 6).alias("odds_ratio"))
    return ratio.crossJoin(rows.agg(*apart))


@query("psm_counts")
def _(spark, d):
    df, pairs = matched(spark, d)
    return M.match_counts(df, "adjusted", pairs)


@query("psm_balance")
def _(spark, d):
    df, pairs = matched(spark, d)
    rows = M.matched_rows(df, "encounter_id", pairs)
    return C.balance(rows, "adjusted", ["age_midpoint", "num_medications", "number_diagnoses"], category_levels(df, ["race", "gender"]))


@query("psm_odds_ratio")
def _(spark, d):
    df, pairs = matched(spark, d)
    return C.weighted_odds_ratio(M.matched_rows(df, "encounter_id", pairs), "adjusted", "y")


@query("aipw_fitted")
def _(spark, d):
    return C.fit_aipw(train_rows(spark, d), "prior", "y", [*PS_COVARIATES, "time_in_hospital"])


@query("causal_summary")
def _(spark, d):
    df = train_rows(spark, d)
    tested = C.stabilised_weights(C.propensity(df, "tested", PS_COVARIATES), "tested", "ps")
    adjusted = C.propensity(df, "adjusted", PS_COVARIATES)
    pairs = match_in_order(adjusted, "encounter_id", "adjusted", "ps")
    pairs_rows = M.matched_rows(adjusted, "encounter_id", pairs)
    return C.summarize_analyses([
        ("lab tested", "ATE", "stabilised weighting", "odds ratio", C.weighted_odds_ratio(tested, "tested", "y", "iptw"), "odds_ratio"),
        ("insulin adjusted", "ATT", "1:1 matching", "odds ratio", C.weighted_odds_ratio(pairs_rows, "adjusted", "y"), "odds_ratio"),
        ("prior inpatient", "ATE", "doubly robust", "risk difference", C.fit_aipw(df, "prior", "y", PS_COVARIATES), "risk_difference"),
    ])


@query("aipw_bootstrap")
def _(spark, d):
    df = train_rows(spark, d)
    point = C.fit_aipw(df, "prior", "y", PS_COVARIATES)
    reps = B.bootstrap_aipw(df, "encounter_id", "prior", "y", PS_COVARIATES)
    return B.normal_interval(point, reps)


# --- closed forms: with a term per cell a logistic fit gives the cells' shares -----

_CELLS = {
    "tw": "SELECT encounter_id, readmitted_30day AS y, CAST(a1cresult <> 'None' AS INTEGER) AS tested, CAST(insulin IN ('Up', 'Down') AS INTEGER) AS adjusted, "
    "CAST(number_inpatient > 0 AS INTEGER) AS prior, gender FROM mart WHERE split_group = 'train' AND gender IS NOT NULL",
    "cw": "SELECT *, AVG(tested) OVER (PARTITION BY gender, prior) AS pt, AVG(prior) OVER (PARTITION BY gender) AS pp, "
    "AVG(CASE WHEN prior = 1 THEN y END) OVER (PARTITION BY gender) AS m1, AVG(CASE WHEN prior = 0 THEN y END) OVER (PARTITION BY gender) AS m0 FROM tw",
}


def cells(spark, d):
    return train_rows(spark, d).where("gender IS NOT NULL")


def cell_propensity(df):
    model = C.fit_logit(df, "tested", ["gender", "prior"], ["gender:prior"], output="ps")
    return model.transform(df).drop("__x")


@query("propensity_cells", with_steps("mart", "SELECT encounter_id, tested, ROUND(pt, 5) AS ps FROM cw", **_CELLS))
def _(spark, d):
    return cell_propensity(cells(spark, d)).select("encounter_id", "tested", F.round("ps", 5).alias("ps"))


@query("toggled_cells", with_steps("mart", "SELECT encounter_id, prior, ROUND(m1, 5) AS m1, ROUND(m0, 5) AS m0 FROM cw", **_CELLS))
def _(spark, d):
    df = cells(spark, d)
    model = C.fit_logit(df, "y", ["prior", "gender"], ["prior:gender"])
    out = C.toggled_predictions(model, df, "prior")
    return out.select("encounter_id", "prior", F.round("m1", 5).alias("m1"), F.round("m0", 5).alias("m0"))


# with the cells' own shares the outcome model cancels: the means are standardised over the cells
_AIPW_CELLS = "SELECT AVG(m1) AS a1, AVG(m0) AS a0 FROM cw"


@query(
    "aipw_cells",
    with_steps(
        "mart",
        "SELECT ROUND(a1, 6) AS mean_1, ROUND(a0, 6) AS mean_0, ROUND(a1 - a0, 6) AS risk_difference, ROUND(a1 / a0, 6) AS risk_ratio FROM ("
        + _AIPW_CELLS + ")",
        **_CELLS,
    ),
)
def _(spark, d):
    out = C.fit_aipw(cells(spark, d), "prior", "y", ["gender"])
    return rounded(out, "mean_1", "mean_0", "risk_difference", "risk_ratio")


@query(
    "causal_summary_cells",
    with_steps(
        "mart",
        "SELECT 'lab tested' AS analysis, 'ATE' AS estimand, 'stabilised weighting' AS method, 'odds ratio' AS metric, "
        "ROUND((s11 * s00) / (s10 * s01), 5) AS estimate FROM (SELECT SUM(w) FILTER (WHERE tested = 1 AND y = 1) AS s11, SUM(w) FILTER (WHERE tested = 1 AND y = 0) AS s10, "
        "SUM(w) FILTER (WHERE tested = 0 AND y = 1) AS s01, SUM(w) FILTER (WHERE tested = 0 AND y = 0) AS s00 FROM ("
        "SELECT *, CASE WHEN tested = 1 THEN AVG(tested) OVER () / pt ELSE (1 - AVG(tested) OVER ()) / (1 - pt) END AS w FROM cw)) "
        "UNION ALL SELECT 'prior inpatient', 'ATE', 'doubly robust', 'risk difference', ROUND(a1 - a0, 5) FROM (" + _AIPW_CELLS + ")",
        **_CELLS,
    ),
)
def _(spark, d):
    df = cells(spark, d)
    tested = C.stabilised_weights(cell_propensity(df), "tested", "ps")
    out = C.summarize_analyses([
        ("lab tested", "ATE", "stabilised weighting", "odds ratio", C.weighted_odds_ratio(tested, "tested", "y", "iptw"), "odds_ratio"),
        ("prior inpatient", "ATE", "doubly robust", "risk difference", C.fit_aipw(df, "prior", "y", ["gender"]), "risk_difference"),
    ])
    return out.withColumn("estimate", F.round("estimate", 5))


# saturated model: coefficients are differences of the cells' log odds
_CELL = " UNION ALL ".join(
    f"SELECT '{name}' AS term, {value} AS estimate, SQRT({var}) AS std_error FROM w"
    for name, value, var in (
        ("(Intercept)", "l00", "v00"),
        ("tested", "l10 - l00", "v10 + v00"),
        ("gender_Male", "l01 - l00", "v01 + v00"),
        ("tested:gender_Male", "l11 - l10 - l01 + l00", "v11 + v10 + v01 + v00"),
    )
)


@query(
    "subgroup_interaction",
    with_steps(
        "mart",
        "SELECT term, ROUND(estimate, 5) AS estimate, ROUND(std_error, 5) AS std_error FROM terms",
        c="SELECT CAST(a1cresult <> 'None' AS INTEGER) AS a, CAST(gender = 'Male' AS INTEGER) AS g, "
        "LN(SUM(readmitted_30day) / SUM(1 - readmitted_30day)) AS l, 1 / SUM(readmitted_30day) + 1 / SUM(1 - readmitted_30day) AS v "
        "FROM mart WHERE split_group = 'train' GROUP BY 1, 2",
        w="SELECT " + ", ".join(f"MAX({x}) FILTER (WHERE a = {a} AND g = {g}) AS {x}{a}{g}" for x in "lv" for a in (0, 1) for g in (0, 1)) + " FROM c",
        terms=_CELL,
    ),
)
def _(spark, d):
    model = C.fit_logit(train_rows(spark, d), "y", ["tested", "gender"], ["tested:gender"])
    out = C.coefficient_table(model)
    return out.select("term", F.round("estimate", 5).alias("estimate"), F.round("std_error", 5).alias("std_error"))


# --- experiment design -------------------------------------------------------

ENROL_TAUS = [round(0.05 + 0.01 * i, 2) for i in range(21)]
ARRS = [0.02, 0.03, 0.04, 0.05, 0.06]
SQL_ENROL = (
    "SELECT tau, n_flagged, ROUND(n_flagged / n, 6) AS pct_flagged, CASE WHEN n_flagged > 0 THEN ROUND(yf / n_flagged, 6) END AS baseline_risk FROM ("
    "SELECT tau, COUNT(*) AS n, COUNT(*) FILTER (WHERE prob >= tau) AS n_flagged, SUM(readmitted_30day) FILTER (WHERE prob >= tau) AS yf FROM mart, "
    "(SELECT CAST(col0 AS DOUBLE) AS tau FROM (VALUES " + ", ".join(f"({t})" for t in ENROL_TAUS) + ")) WHERE split_group = 'holdout' GROUP BY 1)"
)


@query("enrolment_sweep", with_steps("mart", SQL_ENROL))
def _(spark, d):
    holdout = mart(spark, d, R.LABEL, "prob").where("split_group = 'holdout'")
    return rounded(X.enrolment_sweep(threshold_sweep(holdout, "prob", R.LABEL, ENROL_TAUS)), "pct_flagged", "baseline_risk")


@query("enrolment_sweep_fitted")
def _(spark, d):
    covariates = [
        "number_inpatient", "num_medications", "number_diagnoses", "time_in_hospital", "age_midpoint", "diag_1_group",
        "admission_type_group",
    ]
    m = mart(spark, d, R.LABEL, *covariates)
    model = C.fit_logit(m.where("split_group = 'train'"), R.LABEL, covariates)
    scored = model.transform(m.where("split_group = 'holdout'"))
    return X.enrolment_sweep(threshold_sweep(scored, "fitted", R.LABEL, ENROL_TAUS))


# baseline risk of flagged rows per admission group
SQL_SEGMENTS = {
    "sg": "SELECT admission_type_group AS segment, AVG(CASE WHEN prob >= 0.1 THEN readmitted_30day END) AS risk, "
    "AVG(CASE WHEN prob >= 0.1 THEN 1 ELSE 0 END) AS pct_flagged FROM mart WHERE split_group = 'holdout' AND admission_type_group IS NOT NULL GROUP BY 1"
}


def segments(spark, d):
    holdout = mart(spark, d, R.LABEL, "prob", "admission_type_group").where("split_group = 'holdout' AND admission_type_group IS NOT NULL")
    over = F.col("prob") >= R.TRAINING_TAU
    return holdout.groupBy(F.col("admission_type_group").alias("segment")).agg(
        F.avg(F.when(over, F.col(R.LABEL))).alias("risk"), F.avg(F.when(over, 1).otherwise(0)).alias("pct_flagged")
    )


def _values(name, values):
    return f"(SELECT CAST(col0 AS DOUBLE) AS {name} FROM (VALUES {', '.join(f'({v})' for v in values)}))"


@query(
    "effect_scenarios",
    with_steps(
        "mart",
        f"SELECT segment, arr, CASE WHEN risk > 0 THEN ROUND(arr / risk, 6) END AS rrr, ROUND(risk, 6) AS p_control, ROUND(risk - arr, 6) AS p_treatment FROM sg, {_values('arr', ARRS)}",
        **SQL_SEGMENTS,
    ),
)
def _(spark, d):
    out = X.effect_scenarios(segments(spark, d), "risk", ARRS).drop("risk", "pct_flagged")
    return rounded(out, "rrr", "p_control", "p_treatment")


SQL_SIZES = (
    "SELECT segment, pct_flagged, alpha, power, arr, CAST(CEIL(2 * ((za + zb) / h) * ((za + zb) / h)) AS BIGINT) AS n_per_arm FROM ("
    "SELECT *, 2 * ASIN(SQRT(risk)) - 2 * ASIN(SQRT(risk - arr)) AS h FROM sg, "
    f"{_values('arr', ARRS)}, (VALUES (0.05::DOUBLE, 1.959963984540054::DOUBLE), (0.01::DOUBLE, 2.5758293035489004::DOUBLE)) AS al(alpha, za), "
    "(VALUES (0.8::DOUBLE, 0.8416212335729143::DOUBLE), (0.9::DOUBLE, 1.2815515655446004::DOUBLE)) AS pw(power, zb) WHERE risk - arr >= 0)"
)


@query(
    "sample_size_grid",
    with_steps("mart", f'SELECT segment, alpha, power, arr, n_per_arm, 2 * n_per_arm AS n_total FROM ({SQL_SIZES})', **SQL_SEGMENTS),
)
def _(spark, d):
    return X.sample_size(segments(spark, d), "risk", ARRS, [0.05, 0.01], [0.8, 0.9]).drop("risk", "pct_flagged")


@query(
    "power_curve",
    with_steps(
        "mart",
        f"SELECT segment, arr, n_per_arm, ROUND({sql_normal_upper('(-q)')}, 6) AS power FROM ("
        "SELECT *, ABS(2 * ASIN(SQRT(risk)) - 2 * ASIN(SQRT(risk - arr))) * SQRT(n_per_arm / 2) - 1.959963984540054 AS q FROM sg, "
        f"{_values('arr', ARRS)}, (SELECT CAST(i AS INTEGER) AS n_per_arm FROM range(100, 3001, 50) t(i)) WHERE risk - arr >= 0)",
        **SQL_SEGMENTS,
    ),
)
def _(spark, d):
    out = X.power_curve(segments(spark, d), "risk", ARRS, (100, 3000, 50)).drop("risk", "pct_flagged")
    return rounded(out, "power")


@query(
    "feasibility",
    with_steps(
        "mart",
        "SELECT segment, alpha, power, arr, n_per_arm, annual_flagged, annual_per_arm, CASE WHEN annual_per_arm > 0 THEN ROUND(n_per_arm / annual_per_arm, 1) END AS years_required FROM ("
        "SELECT *, annual_flagged // 2 AS annual_per_arm FROM (SELECT *, CAST(ROUND(5000 * pct_flagged) AS BIGINT) AS annual_flagged FROM (" + SQL_SIZES + ")))",
        **SQL_SEGMENTS,
    ),
)
def _(spark, d):
    sizes = X.sample_size(segments(spark, d), "risk", ARRS, [0.05, 0.01], [0.8, 0.9])
    return X.feasibility(sizes, "pct_flagged", 5000).drop("risk", "pct_flagged", "n_total")


@query(
    "block_randomize",
    with_steps(
        "features",
        "SELECT age_group, admission_type_group, encounter_id, block, CASE WHEN ROW_NUMBER() OVER (PARTITION BY age_group, admission_type_group, block "
        "ORDER BY md5(encounter_id || ':1'), encounter_id) <= 2 THEN 1 ELSE 0 END AS arm FROM ("
        "SELECT age_group, admission_type_group, encounter_id, (ROW_NUMBER() OVER (PARTITION BY age_group, admission_type_group ORDER BY encounter_id) - 1) // 4 AS block FROM features)",
    ),
)
def _(spark, d):
    return X.block_randomize(features(spark, d), "encounter_id", ["age_group", "admission_type_group"], 4)


LOOK_BOUNDS = [4.049, 2.863, 2.337, 2.024]


@query(
    "interim_looks",
    with_steps(
        "staged",
        "SELECT look, n1, n0, y1, y0, ROUND(z, 6) AS z, bound, COALESCE(ABS(z) >= bound, FALSE) AS crossed FROM (SELECT *, CASE WHEN se > 0 THEN (y1 / n1 - y0 / n0) / se END AS z FROM ("
        "SELECT *, SQRT((y1 + y0) / (n1 + n0) * (1 - (y1 + y0) / (n1 + n0)) * (1 / n1 + 1 / n0)) AS se FROM ("
        "SELECT look, CAST(SUM(a1) OVER w AS BIGINT) AS n1, CAST(SUM(a0) OVER w AS BIGINT) AS n0, CAST(SUM(b1) OVER w AS BIGINT) AS y1, CAST(SUM(b0) OVER w AS BIGINT) AS y0, bound FROM ("
        "SELECT CAST(number_diagnoses % 4 + 1 AS INTEGER) AS look, COUNT(*) FILTER (WHERE arm = 1) AS a1, COUNT(*) FILTER (WHERE arm = 0) AS a0, "
        "SUM(readmitted_30day) FILTER (WHERE arm = 1) AS b1, SUM(readmitted_30day) FILTER (WHERE arm = 0) AS b0 FROM (SELECT *, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS arm FROM staged) GROUP BY 1) "
        "JOIN (VALUES (1, 4.049::DOUBLE), (2, 2.863::DOUBLE), (3, 2.337::DOUBLE), (4, 2.024::DOUBLE)) AS b(look, bound) USING (look) WINDOW w AS (ORDER BY look))))",
    ),
)
def _(spark, d):
    df = staged(spark, d).select(
        (F.col("number_diagnoses") % 4 + 1).alias("look"), flag(F.col("gender") == "Male").alias("arm"), R.LABEL
    )
    return rounded(X.interim_looks(df, "look", "arm", R.LABEL, LOOK_BOUNDS), "z")
