"""Catalog: drift of ordered holdout batches against the training split."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import drift as D
from tallyward.plans import encounter_rules as R
from tallyward.plans.catalog_base import Catalog, mart, rounded, with_steps
from tallyward.sources.fixtures import table

catalog = Catalog()
query = catalog.query

FEATURES = R.DRIFT_FEATURES
N_BATCHES = 4

SQL_BATCHED = (
    "SELECT *, CAST(LEAST(r // (n // 4), 3) + 1 AS INTEGER) AS batch FROM ("
    "SELECT *, ROW_NUMBER() OVER (ORDER BY encounter_id) - 1 AS r, COUNT(*) OVER () AS n FROM mart WHERE split_group = 'holdout')"
)


def _long(src, features, keep):
    return " UNION ALL ".join(f"SELECT {keep}, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {src} WHERE {f} IS NOT NULL" for f in features)


def psi_steps(ref: str, cur: str, period: str, features, n_bins=10) -> dict:
    probs = ", ".join(str(i / n_bins) for i in range(n_bins + 1))
    return {
        "rl": _long(ref, features, "0 AS z"),
        "cl": _long(cur, features, f"{period} AS period"),
        "ed": f"SELECT feature, list_sort(list_distinct(quantile_cont(v, [{probs}]))) AS e FROM rl GROUP BY 1",
        "bins": "SELECT feature, i, e[i] AS lo, e[i + 1] AS hi, i = len(e) - 1 AS last, len(e) < 3 AS degenerate "
        "FROM ed, range(1, 11) t(i) WHERE i < len(e) OR (len(e) < 3 AND i = 1)",
        "rc": "SELECT b.feature, i, COUNT(*) AS c FROM bins b JOIN rl ON rl.feature = b.feature AND v >= lo AND (v < hi OR (last AND v = hi)) GROUP BY 1, 2",
        "cc": "SELECT period, b.feature, i, COUNT(*) AS c FROM bins b JOIN cl ON cl.feature = b.feature AND v >= lo AND (v < hi OR (last AND v = hi)) GROUP BY 1, 2, 3",
        "ax": "SELECT period, feature, i, degenerate FROM (SELECT DISTINCT period, feature FROM cl) JOIN bins USING (feature)",
        "ct": "SELECT period, feature, SUM(c) AS t FROM cc GROUP BY 1, 2",
        "rt": "SELECT feature, SUM(c) AS t FROM rc GROUP BY 1",
        "sh": "SELECT ax.period, ax.feature, ax.degenerate, GREATEST(COALESCE(rc.c, 0) / rt.t, 1e-4) AS e, GREATEST(COALESCE(cc.c, 0) / ct.t, 1e-4) AS a, ct.t "
        "FROM ax LEFT JOIN rc ON rc.feature = ax.feature AND rc.i = ax.i LEFT JOIN cc ON cc.period = ax.period AND cc.feature = ax.feature AND cc.i = ax.i "
        "LEFT JOIN rt ON rt.feature = ax.feature LEFT JOIN ct ON ct.period = ax.period AND ct.feature = ax.feature",
        "ps": "SELECT period, feature, degenerate, CASE WHEN degenerate THEN 0.0 WHEN MAX(t) IS NULL THEN NULL ELSE SUM((a - e) * LN(a / e)) END AS psi FROM sh GROUP BY 1, 2, 3",
    }


def batches(spark, d):
    m = mart(spark, d, R.LABEL, "prob", *FEATURES)
    train = m.where("split_group = 'train'")
    holdout = D.ordered_batches(m.where("split_group = 'holdout'"), R.KEY, N_BATCHES)
    return train, holdout.withColumn("batch", F.col("batch") + 1)


BASE = {"tr": "SELECT * FROM mart WHERE split_group = 'train'", "ho": SQL_BATCHED}


@query(
    "psi_features",
    with_steps(
        "mart",
        "SELECT period AS batch, feature, ROUND(psi, 6) AS psi, degenerate FROM ps",
        **BASE,
        **psi_steps("tr", "ho", "batch", FEATURES),
    ),
)
def _(spark, d):
    train, holdout = batches(spark, d)
    return rounded(D.psi(D.fit_psi_reference(train, FEATURES), holdout, "batch"), "psi")


@query(
    "psi_lineitem",
    "WITH "
    + ", ".join(
        f"{n} AS MATERIALIZED ({q})"
        for n, q in {
            "tr": "SELECT * FROM lineitem WHERE l_shipdate < DATE '1997-01-01'",
            "ho": "SELECT *, CAST(YEAR(l_shipdate) AS INTEGER) AS yr FROM lineitem WHERE l_shipdate >= DATE '1997-01-01'",
            **psi_steps("tr", "ho", "yr", ["l_quantity", "l_extendedprice", "l_discount"]),
        }.items()
    )
    + " SELECT period AS yr, feature, ROUND(psi, 6) AS psi, degenerate FROM ps",
)
def _(spark, d):
    items = table(spark, d, "lineitem").withColumn("yr", F.year("l_shipdate"))
    before = items.where(F.col("l_shipdate") < F.to_timestamp_ntz(F.lit("1997-01-01 00:00:00")))
    after = items.where(F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit("1997-01-01 00:00:00")))
    fitted = D.fit_psi_reference(before, ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(D.psi(fitted, after, "yr"), "psi")


SQL_KS = {
    "ks1": "SELECT b.batch, x.prob AS x FROM (SELECT DISTINCT batch FROM ho) b, (SELECT DISTINCT prob FROM tr UNION SELECT DISTINCT prob FROM ho) x",
    "ft": "SELECT x, (SELECT COUNT(*) FROM tr) AS n, SUM(COALESCE(c, 0)) OVER (ORDER BY x) / (SELECT COUNT(*) FROM tr) AS f "
    "FROM (SELECT DISTINCT x FROM ks1) LEFT JOIN (SELECT prob AS x, COUNT(*) AS c FROM tr GROUP BY 1) USING (x)",
    "fb": "SELECT batch, x, SUM(COALESCE(c, 0)) OVER (PARTITION BY batch) AS m, SUM(COALESCE(c, 0)) OVER (PARTITION BY batch ORDER BY x) / SUM(COALESCE(c, 0)) OVER (PARTITION BY batch) AS f "
    "FROM ks1 LEFT JOIN (SELECT batch, prob AS x, COUNT(*) AS c FROM ho GROUP BY 1, 2) USING (batch, x)",
    "ks": "SELECT batch, MAX(ABS(ft.f - fb.f)) AS d, MAX(n) AS n, CAST(MAX(m) AS BIGINT) AS m FROM ft JOIN fb USING (x) GROUP BY 1",
    "kp": "SELECT batch, n, m, d, CASE WHEN d * SQRT(n * m / (n + m)) < 0.2 THEN 1.0 ELSE GREATEST(LEAST(2 * (SELECT SUM(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END "
    "* EXP(-2.0 * k * k * d * d * (n * m / (n + m)))) FROM range(1, 101) t(k)), 1.0), 0.0) END AS p FROM ks",
}


@query(
    "ks_scores",
    with_steps(
        "mart",
        "SELECT batch, n AS n_ref, m AS n_cur, ROUND(d, 6) AS ks_stat, ROUND(p, 6) AS ks_pval FROM kp",
        **BASE,
        **SQL_KS,
    ),
)
def _(spark, d):
    train, holdout = batches(spark, d)
    out = D.ks_by_period(train, holdout, "prob", "batch", list(range(1, N_BATCHES + 1)))
    return rounded(out, "ks_stat", "ks_pval")


def report(spark, d):
    m = mart(spark, d, R.LABEL, "prob", *FEATURES)
    return D.drift_report(
        m.where("split_group = 'train'"),
        m.where("split_group = 'holdout'"),
        R.KEY,
        "prob",
        R.LABEL,
        FEATURES,
        N_BATCHES,
        R.DEPLOYED_TAU,
    )


SQL_REPORT = {
    **BASE,
    **psi_steps("tr", "ho", "batch", FEATURES),
    **SQL_KS,
    "au": "SELECT batch, CASE WHEN n1 > 0 AND n0 > 0 THEN (r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0) END AS auc FROM (SELECT batch, SUM(readmitted_30day) AS n1, "
    "SUM(1 - readmitted_30day) AS n0, COALESCE(SUM(r) FILTER (WHERE readmitted_30day = 1), 0) AS r1 FROM (SELECT batch, readmitted_30day, RANK() OVER (PARTITION BY batch ORDER BY prob) "
    "+ (COUNT(*) OVER (PARTITION BY batch, prob) - 1) / 2.0 AS r FROM ho) GROUP BY 1)",
    "rt2": "SELECT batch, COUNT(*) AS n, AVG(CASE WHEN prob >= 0.12 THEN 1 ELSE 0 END) AS flag_rate, AVG(readmitted_30day) AS pos_rate FROM ho GROUP BY 1",
    "mp": "SELECT period AS batch, AVG(psi) AS mean_psi, MAX(psi) AS max_psi FROM ps GROUP BY 1",
    "rep": "SELECT batch, rt2.n AS n_rows, auc AS auc_roc, flag_rate, pos_rate, d AS ks_stat, p AS ks_pval, mean_psi, max_psi, mean_psi > 0.20 OR d > 0.10 AS drift_alert "
    "FROM rt2 JOIN au USING (batch) JOIN kp USING (batch) JOIN mp USING (batch)",
}


@query(
    "drift_report",
    with_steps(
        "mart",
        "SELECT batch, n_rows, ROUND(auc_roc, 6) AS auc_roc, ROUND(flag_rate, 6) AS flag_rate, ROUND(pos_rate, 6) AS pos_rate, ROUND(ks_stat, 6) AS ks_stat, "
        "ROUND(ks_pval, 6) AS ks_pval, ROUND(mean_psi, 6) AS mean_psi, drift_alert, feature, ROUND(psi, 6) AS psi FROM rep JOIN ps ON ps.period = rep.batch",
        **SQL_REPORT,
    ),
)
def _(spark, d):
    # the map column is opened to rows so that SQL can check every value
    rep = report(spark, d)
    cols = [c for c in rep.columns if c != "psi_by_feature"]
    out = rep.select(*cols, F.explode("psi_by_feature").alias("feature", "psi"))
    return rounded(out, "auc_roc", "flag_rate", "pos_rate", "ks_stat", "ks_pval", "mean_psi", "psi")


@query(
    "drift_alerts",
    with_steps(
        "mart",
        "SELECT batch, drift_alert, CASE WHEN mean_psi < 0.1 THEN 'stable' WHEN mean_psi <= 0.2 THEN 'watch' ELSE 'shifted' END AS psi_band, "
        "COALESCE((SELECT string_agg(feature, ',' ORDER BY feature) FROM ps WHERE ps.period = rep.batch AND psi > 0.1), '') AS psi_flags FROM rep",
        **SQL_REPORT,
    ),
)
def _(spark, d):
    return D.drift_alerts(report(spark, d)).withColumn("psi_flags", F.array_join("psi_flags", ","))


@query(
    "psi_matrix",
    with_steps(
        "mart",
        "SELECT feature, "
        + ", ".join(f"ROUND(MAX(psi) FILTER (WHERE period = {b}), 6) AS batch_{b}" for b in (1, 2, 3, 4))
        + " FROM ps GROUP BY 1",
        **SQL_REPORT,
    ),
)
def _(spark, d):
    numbers = [1, 2, 3, 4]
    return rounded(D.psi_matrix(report(spark, d), numbers), *[f"batch_{b}" for b in numbers])


@query(
    "drift_summary",
    with_steps(
        "mart",
        "SELECT COUNT(*) AS n_batches, ROUND(MAX(ks_stat), 6) AS max_ks, arg_max(batch, ks_stat) AS max_ks_batch, ROUND(MAX(mean_psi), 6) AS max_mean_psi, "
        "ROUND(MAX(max_psi), 6) AS max_feature_psi, COUNT(*) FILTER (WHERE drift_alert) AS n_alerts, ROUND(arg_max(auc_roc, batch) - arg_min(auc_roc, batch), 6) AS auc_change FROM rep",
        **SQL_REPORT,
    ),
)
def _(spark, d):
    return rounded(D.drift_summary(report(spark, d)), "max_ks", "max_mean_psi", "max_feature_psi", "auc_change")
