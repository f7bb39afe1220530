"""Catalog: profiling statistics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tallyward.functions.scalar import flag
from tallyward.operators import gram as G
from tallyward.operators import profile as P
from tallyward.plans import encounter_rules as R
from tallyward.plans.catalog_base import MEDS, PRIOR, Catalog, features, mart, rounded, sql_normal_upper, staged, with_steps
from tallyward.sources.fixtures import table

catalog = Catalog()
query = catalog.query

TEXT_COLUMNS = ["race", "gender", "age", "weight", "payer_code", "medical_specialty"]
DOSES = [*R.LAB_COLUMNS, *R.RAW_MEDICATIONS, "change", "diabetes_med", "readmitted_raw"]
MISSING_COLUMNS = [
    *R.ID_COLUMNS, *TEXT_COLUMNS, *R.COUNT_COLUMNS, "diag_1", "diag_2", "diag_3", *DOSES, "readmitted_30day", "readmitted_any",
]
SQL_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing, COUNT(*) AS total FROM staged"
    for c in MISSING_COLUMNS
)


@query(
    "missingness",
    with_steps(
        "staged",
        f"SELECT variable, n_missing, ROUND(n_missing / total, 6) AS pct_missing FROM ({SQL_MISSING}) WHERE n_missing > 0",
    ),
)
def _(spark, d):
    return rounded(P.missingness(staged(spark, d), MISSING_COLUMNS), "pct_missing")


DECISIONS = [
    ("medical_specialty", "not at random", "explicit category"),
    ("diag_3", "structural", "category None"),
    ("diag_2", "structural", "category None"),
    ("age", "none expected", "keep"),
]


@query(
    "missingness_decisions",
    with_steps(
        "staged",
        "SELECT variable, ROUND(pct, 6) AS pct_missing, mechanism, decision FROM (VALUES "
        + ", ".join(str(x) for x in DECISIONS)
        + f") AS v(variable, mechanism, decision) LEFT JOIN (SELECT variable, n_missing / total AS pct FROM ({SQL_MISSING}) "
        "WHERE n_missing > 0) USING (variable)",
    ),
)
def _(spark, d):
    small = spark.createDataFrame(DECISIONS, "variable string, mechanism string, decision string")
    profile = P.missingness(staged(spark, d), MISSING_COLUMNS).select("variable", "pct_missing")
    return rounded(small.join(profile, "variable", "left"), "pct_missing").select(
        "variable", "pct_missing", "mechanism", "decision"
    )


NZV_COLUMNS = [*TEXT_COLUMNS, *DOSES]


@query(
    "nzv",
    with_steps(
        "staged",
        "SELECT variable, ROUND(MAX(c) / SUM(c), 6) AS dominant_share FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS variable, COUNT(*) AS c FROM staged WHERE {c} IS NOT NULL GROUP BY {c}" for c in NZV_COLUMNS
        )
        + ") GROUP BY variable HAVING MAX(c) / SUM(c) > 0.95",
    ),
)
def _(spark, d):
    return rounded(P.near_zero_variance(staged(spark, d), NZV_COLUMNS), "dominant_share")


@query(
    "outcome_share",
    with_steps(
        "staged",
        "SELECT readmitted_raw, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share FROM staged GROUP BY 1",
    ),
)
def _(spark, d):
    return rounded(P.outcome_share(staged(spark, d), "readmitted_raw"), "share")


@query(
    "two_way_share",
    with_steps(
        "features",
        "SELECT age_group, readmitted_raw, COUNT(*) AS n, "
        "ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY age_group), 6) AS share FROM features GROUP BY 1, 2",
    ),
)
def _(spark, d):
    return rounded(P.two_way_share(features(spark, d), "age_group", "readmitted_raw"), "share")


@query(
    "two_way_share_lineitem",
    "SELECT l_shipyear, l_returnflag, COUNT(*) AS n, "
    "ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY l_shipyear), 6) AS share "
    "FROM (SELECT CAST(YEAR(l_shipdate) AS INTEGER) AS l_shipyear, l_returnflag FROM lineitem) GROUP BY 1, 2",
)
def _(spark, d):
    items = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("l_shipyear"), "l_returnflag")
    return rounded(P.two_way_share(items, "l_shipyear", "l_returnflag"), "share")


@query(
    "status_long_counts",
    with_steps(
        "staged",
        "SELECT variable, status, n, ROUND(n / SUM(n) OVER (PARTITION BY variable), 6) AS share FROM ("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS variable, {m} AS status, COUNT(*) AS n FROM staged WHERE {m} <> 'No' GROUP BY {m}" for m in MEDS
        )
        + ")",
    ),
)
def _(spark, d):
    return rounded(P.status_counts(staged(spark, d), MEDS, "No"), "share")


HIST_COLUMNS = [c for c in R.NUMERIC_FEATURES if c not in PRIOR]


@query(
    "hist_by_label",
    with_steps(
        "features",
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, readmitted_30day, CAST(LEAST(FLOOR(CAST({c} - lo AS DOUBLE) / (hi - lo) * 30), 29) AS INTEGER) AS bin, "
            f"COUNT(*) AS n FROM features, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM features) GROUP BY ALL"
            for c in HIST_COLUMNS
        ),
    ),
)
def _(spark, d):
    return P.histogram_by_label(features(spark, d), HIST_COLUMNS, "readmitted_30day", 30)


@query(
    "hist_lineitem",
    "SELECT 'l_extendedprice' AS variable, l_returnflag, "
    "CAST(LEAST(FLOOR((l_extendedprice - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, COUNT(*) AS n "
    "FROM lineitem, (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem) GROUP BY ALL",
)
def _(spark, d):
    return P.histogram_by_label(table(spark, d, "lineitem"), ["l_extendedprice"], "l_returnflag", 30)


CAT_COLUMNS = [*R.NOMINAL_FEATURES, *R.LAB_COLUMNS, *R.MEDICATIONS, "readmitted_raw", R.SPLIT]


def _sql_table1_cat(cols, digits=6):
    long = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS level, readmitted_30day AS y FROM mart WHERE {c} IS NOT NULL" for c in cols)
    return with_steps(
        "mart",
        "SELECT v.variable, level, n, ROUND(100 * n / t, 6) AS pct, n_0, ROUND(100 * n_0 / t0, 6) AS pct_0, "
        f"n_1, ROUND(100 * n_1 / t1, 6) AS pct_1, ROUND(chi2, {digits}) AS chi2, dof FROM v JOIN s USING (variable) JOIN x USING (variable)",
        l=long,
        v="SELECT variable, level, COUNT(*) AS n, COUNT(*) FILTER (WHERE y = 0) AS n_0, COUNT(*) FILTER (WHERE y = 1) AS n_1 FROM l GROUP BY 1, 2",
        s="SELECT variable, SUM(n) AS t, SUM(n_0) AS t0, SUM(n_1) AS t1, COUNT(*) AS k FROM v GROUP BY 1",
        e="SELECT variable, ABS(n_0 - n * t0 / t) AS d0, n * t0 / t AS e0, ABS(n_1 - n * t1 / t) AS d1, n * t1 / t AS e1, k FROM v JOIN s USING (variable)",
        x="SELECT variable, COUNT(*) - 1 AS dof, SUM(CASE WHEN k = 2 THEN POW(d0 - LEAST(0.5, d0), 2) / e0 + POW(d1 - LEAST(0.5, d1), 2) / e1 "
        "ELSE d0 * d0 / e0 + d1 * d1 / e1 END) AS chi2 FROM e GROUP BY 1",
    )


@query("table1_cat", _sql_table1_cat(CAT_COLUMNS))
def _(spark, d):
    out = P.table1_categorical(mart(spark, d, R.LABEL, *[c for c in CAT_COLUMNS if c != R.SPLIT]), CAT_COLUMNS, "readmitted_30day", [0, 1])
    return rounded(out, "pct", "pct_0", "pct_1", "chi2").drop("p_value")


def _sql_chi2_upper(x: str, dof: str) -> str:
    """Tail of chi-square with whole degrees of freedom, by the gamma function's finite sum."""
    half, odd = f"({x} / 2)", f"({dof} % 2 / 2)"
    series = f"COALESCE(list_sum([POW({half}, i + {odd}) / GAMMA(i + 1 + {odd}) FOR i IN range(0, {dof} // 2)]), 0)"
    return (
        f"(CASE WHEN {x} <= 0 THEN 1.0 ELSE LEAST(EXP(-{half}) * {series} + "
        f"IF({dof} % 2 = 1, 2 * {sql_normal_upper(f'SQRT({x})')}, 0), 1.0) END)"
    )


@query(
    "table1_cat_p",
    f"SELECT DISTINCT variable, dof, ROUND({_sql_chi2_upper('chi2', 'dof')}, 6) AS p_value FROM ({_sql_table1_cat(CAT_COLUMNS, 12)})",
)
def _(spark, d):
    out = P.table1_categorical(mart(spark, d, R.LABEL, *[c for c in CAT_COLUMNS if c != R.SPLIT]), CAT_COLUMNS, "readmitted_30day", [0, 1])
    return rounded(out.select("variable", "dof", "p_value").distinct(), "p_value")


CONT_COLUMNS = R.NUMERIC_FEATURES


def _sql_table1_cont(cols, digits=6):
    long = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS v, readmitted_30day AS y FROM features WHERE {c} IS NOT NULL" for c in cols)
    stats = ", ".join(
        f"quantile_cont(v, {p}){f} AS {name}{s}"
        for s, f in (("", ""), ("_0", " FILTER (WHERE y = 0)"), ("_1", " FILTER (WHERE y = 1)"))
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    return with_steps(
        "features",
        f"SELECT q.*, CAST(1 AS INTEGER) AS dof, ROUND((12.0 / (t * (t + 1.0)) * (r0 * r0 / n0 + r1 * r1 / n1) - 3 * (t + 1.0)) / (1 - ties / (t * t * t - t)), {digits}) AS h "
        "FROM q JOIN k USING (variable) JOIN w USING (variable)",
        l=long,
        q=f"SELECT variable, {stats} FROM l GROUP BY 1",
        ra="SELECT variable, y, RANK() OVER (PARTITION BY variable ORDER BY v) + (COUNT(*) OVER (PARTITION BY variable, v) - 1) / 2.0 AS r FROM l",
        k="SELECT variable, CAST(COUNT(*) AS DOUBLE) AS t, SUM(r) FILTER (WHERE y = 0) AS r0, SUM(r) FILTER (WHERE y = 1) AS r1, "
        "COUNT(*) FILTER (WHERE y = 0) AS n0, COUNT(*) FILTER (WHERE y = 1) AS n1 FROM ra GROUP BY 1",
        w="SELECT variable, SUM(c * c * c - c) AS ties FROM (SELECT variable, CAST(COUNT(*) AS DOUBLE) AS c FROM l GROUP BY variable, v) GROUP BY 1",
    )


@query("table1_cont", _sql_table1_cont(CONT_COLUMNS))
def _(spark, d):
    out = P.table1_continuous(features(spark, d), CONT_COLUMNS, "readmitted_30day", [0, 1])
    return rounded(out, "h").drop("p_value")


@query(
    "table1_cont_p",
    f"SELECT variable, dof, ROUND({_sql_chi2_upper('h', 'dof')}, 6) AS p_value FROM ({_sql_table1_cont(CONT_COLUMNS, 12)})",
)
def _(spark, d):
    out = P.table1_continuous(features(spark, d), CONT_COLUMNS, "readmitted_30day", [0, 1])
    return rounded(out, "p_value").select("variable", "dof", "p_value")


RANK_COLUMNS = [*R.NUMERIC_FEATURES, R.LABEL]


def _sql_spearman(cols):
    parts = []
    for x, y in combinations(cols, 2):
        rank = lambda c: f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0"
        parts.append(
            f"SELECT '{x}' AS var1, '{y}' AS var2, ROUND(corr(rx, ry), 6) AS rho FROM "
            f"(SELECT {rank(x)} AS rx, {rank(y)} AS ry FROM features WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
        )
    return with_steps("features", " UNION ALL ".join(parts))


@query("spearman_matrix", _sql_spearman(RANK_COLUMNS))
def _(spark, d):
    return rounded(G.spearman(features(spark, d), RANK_COLUMNS), "rho")


V_COLUMNS = [
    *[c for c in R.NOMINAL_FEATURES if c != "age_band"], *R.LAB_COLUMNS,
    *[m for m in R.MODELLED_MEDICATIONS if m not in ("repaglinide", "rosiglitazone")], R.LABEL,
]


def _sql_cramers(cols, src):
    parts = []
    for x, y in combinations(cols, 2):
        parts.append(
            f"SELECT '{x}' AS var1, '{y}' AS var2, CASE WHEN LEAST(r, c) > 1 THEN "
            f"ROUND(SQRT(GREATEST(s - 1, 0.0) / (LEAST(r, c) - 1)), 6) END AS v FROM (SELECT SUM(CAST(n AS DOUBLE) * n / (CAST(na AS DOUBLE) * nb)) AS s, "
            f"COUNT(DISTINCT a) AS r, COUNT(DISTINCT b) AS c FROM (SELECT a, b, n, SUM(n) OVER (PARTITION BY a) AS na, SUM(n) OVER (PARTITION BY b) AS nb "
            f"FROM (SELECT {x} AS a, {y} AS b, COUNT(*) AS n FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2)))"
        )
    return " UNION ALL ".join(parts)


@query("cramers_v", with_steps("features", _sql_cramers(V_COLUMNS, "features")))
def _(spark, d):
    return rounded(G.cramers_v(features(spark, d), V_COLUMNS), "v")


@query("cramers_v_part", _sql_cramers(["p_brand", "p_type", "p_size"], "part"))
def _(spark, d):
    return rounded(G.cramers_v(table(spark, d, "part"), ["p_brand", "p_type", "p_size"]), "v")


@query(
    "class_weights",
    with_steps(
        "features",
        "SELECT readmitted_30day, n, ROUND(t / (2 * n), 6) AS weight, ROUND(neg / pos, 6) AS neg_pos_ratio FROM "
        "(SELECT readmitted_30day, COUNT(*) AS n FROM features GROUP BY 1), "
        "(SELECT COUNT(*) AS t, SUM(readmitted_30day) AS pos, SUM(1 - readmitted_30day) AS neg FROM features)",
    ),
)
def _(spark, d):
    return rounded(P.class_weights(features(spark, d), R.LABEL), "weight", "neg_pos_ratio")


@query(
    "class_weights_labels",
    "SELECT toxic, n, ROUND(t / (2 * n), 6) AS weight, ROUND(neg / pos, 6) AS neg_pos_ratio FROM "
    "(SELECT toxic, COUNT(*) AS n FROM labels GROUP BY 1), "
    "(SELECT COUNT(*) AS t, SUM(toxic) AS pos, SUM(1 - toxic) AS neg FROM labels)",
)
def _(spark, d):
    return rounded(P.class_weights(table(spark, d, "labels"), "toxic"), "weight", "neg_pos_ratio")


@query(
    "score_overlap",
    with_steps(
        "features",
        "SELECT tested, bin, n, ROUND(median, 6) AS median FROM (SELECT tested, CAST(LEAST(FLOOR(prob * 20), 19) AS INTEGER) AS bin, COUNT(*) AS n FROM t GROUP BY 1, 2) "
        "JOIN (SELECT tested, quantile_cont(prob, 0.5) AS median FROM t GROUP BY 1) USING (tested)",
        t="SELECT CASE WHEN a1cresult <> 'None' THEN 1 ELSE 0 END AS tested, prob FROM features",
    ),
)
def _(spark, d):
    df = features(spark, d).withColumn("tested", flag(F.col("a1cresult") != "None"))
    return rounded(P.score_overlap(df, "tested", "prob", 20), "median")


@query(
    "treated_share",
    with_steps(
        "features",
        "SELECT COUNT(*) FILTER (WHERE a = 1) AS n_treated, ROUND(AVG(a), 6) AS treated_share, "
        "COUNT(*) FILTER (WHERE a = 0) AS n_control, ROUND(1 - AVG(a), 6) AS control_share "
        "FROM (SELECT CASE WHEN insulin IN ('Up', 'Down') THEN 1 ELSE 0 END AS a FROM features)",
    ),
)
def _(spark, d):
    df = features(spark, d).withColumn("a", flag(F.col("insulin").isin("Up", "Down")))
    return rounded(P.treated_share(df, "a"), "treated_share", "control_share")


@query(
    "mean_abs_ranked",
    "SELECT feature, ROUND(mean_abs, 6) AS mean_abs, CAST(ROW_NUMBER() OVER (ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, AVG(ABS({c})) AS mean_abs FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    + ")",
)
def _(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(P.mean_abs_ranked(table(spark, d, "lineitem"), cols), "mean_abs")


@query(
    "topk",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def _(spark, d):
    return P.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), F.desc("o_totalprice"), 20, "o_orderkey")


@query(
    "baseline_risk",
    with_steps(
        "mart",
        "SELECT ROUND(AVG(readmitted_30day) FILTER (WHERE number_inpatient = 0), 6) AS risk_none, "
        "ROUND(AVG(readmitted_30day) FILTER (WHERE number_inpatient > 0), 6) AS risk_any FROM features",
    ),
)
def _(spark, d):
    y, prior = F.col(R.LABEL), F.col("number_inpatient") > 0
    return rounded(
        features(spark, d).agg(F.avg(F.when(~prior, y)).alias("risk_none"), F.avg(F.when(prior, y)).alias("risk_any")),
        "risk_none",
        "risk_any",
    )
