"""Population stability, score distribution shift and the per-batch report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.stats import kolmogorov_p
from tallyward.operators.ordered import exact_quantiles, ordered_batches
from tallyward.operators.profile import to_long
from tallyward.operators.tagged import score_counts, tagged_metrics

PSI_FLOOR = 1e-4
PSI_ALERT = 0.20
PSI_WATCH = 0.10
KS_ALERT = 0.10


@dataclass(frozen=True)
class PsiReference:
    """Fitted bins of one feature: distinct edges and the reference's shares."""

    feature: str
    edges: tuple[float, ...]
    shares: tuple[float, ...]

    @property
    def degenerate(self) -> bool:
        return len(self.edges) < 3


def fit_psi_reference(
    reference: DataFrame, features: Sequence[str], n_bins: int = 10, approx: bool = False
) -> list[PsiReference]:
    """Quantile bins and shares of the reference, fitted once and reused per batch.

    Exact edges order all distinct values of all features together. ``approx``
    trades that shuffle for a sketch on wide-ranging features. What returns to
    the driver is at most ``n_bins + 1`` numbers per feature.
    """
    long = to_long(reference, [], features, "double")
    probs = [i / n_bins for i in range(n_bins + 1)]
    if approx:
        q = long.groupBy("variable").agg(F.percentile_approx("value", probs, 10_000).alias("quantiles"))
    else:
        q = exact_quantiles(long, "value", probs, ["variable"])
    found = {r["variable"]: tuple(sorted(set(r["quantiles"]))) for r in q.collect()}
    edges = {f: found.get(f, ()) for f in features}
    counts: dict[str, dict[int, int]] = {f: {} for f in features}
    for r in _cell_counts(reference, edges, []).collect():
        counts[r["feature"]][r["cell"]] = r["c"]
    fitted = []
    for f in features:
        inside = [counts[f].get(i, 0) for i in range(1, len(edges[f]))]
        total = sum(inside)
        fitted.append(PsiReference(f, edges[f], tuple(c / total for c in inside) if total else ()))
    return fitted


def cell_columns(edges: Mapping[str, Sequence[float]]) -> dict[str, Column]:
    """Cell of each feature's value: 1-based, [e_i, e_i+1) with the last one closed; 0 or one past the end lies outside.

    Cells are plain comparisons with literals; NULL has none.
    """
    cells = {}
    for f, cuts in edges.items():
        v = F.col(f).cast("double")
        cell = F.lit(0)
        for e in cuts:
            cell = cell + F.when(v >= F.lit(e), 1).otherwise(0)
        if cuts:
            cell = cell - F.when(v == F.lit(cuts[-1]), 1).otherwise(0)
        cells[f] = F.when(v.isNotNull(), cell)
    return cells


def _cell_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """Counts per (keep, feature, cell), combined on the map side."""
    cells = cell_columns(edges)
    slim = df.select(*keep, *[c.alias(f) for f, c in cells.items()])
    long = slim.unpivot(list(keep), list(cells), "feature", "cell").where("cell IS NOT NULL")
    return long.groupBy(*keep, "feature", "cell").agg(F.count("*").alias("c"))


def psi(reference: Sequence[PsiReference], current: DataFrame, period: str) -> DataFrame:
    """PSI per (period, feature) of ``current`` against fitted bins.

    Values outside the reference range are left out of both counts, shares are
    floored and not renormalised. Fewer than three distinct edges give 0 and
    ``degenerate``; no value inside the range gives NULL. One pass over
    ``current``; what is shuffled are counts per period, feature and bin.
    """
    return psi_from_counts(reference, cell_counts(reference, current, period), period)


def cell_counts(reference: Sequence[PsiReference], current: DataFrame, period: str) -> DataFrame:
    """Rows (period, feature, cell, c): the additive state behind :func:`psi`."""
    edges = {ref.feature: ref.edges for ref in reference}
    return _cell_counts(current.where(F.col(period).isNotNull()), edges, [period])


def psi_from_counts(reference: Sequence[PsiReference], counts: DataFrame, period: str) -> DataFrame:
    """PSI from counts per bin, however they were gathered."""
    expected = F.create_map(
        *[
            x
            for ref in reference
            for x in (
                F.lit(ref.feature),
                F.array(*[F.lit(max(s, PSI_FLOOR)) for s in ref.shares]).cast("array<double>"),
            )
        ]
    )
    degenerate = [ref.feature for ref in reference if ref.degenerate]
    counted = (
        counts.groupBy(period, "feature")
        .agg(F.map_from_entries(F.collect_list(F.struct("cell", "c"))).alias("cells"))
        .withColumn("expected", F.try_element_at(expected, F.col("feature")))
    )
    actual = F.transform(
        F.col("expected"), lambda _, i: F.coalesce(F.try_element_at("cells", (i + 1).cast("int")), F.lit(0))
    )
    flag = F.col("feature").isin(*degenerate) if degenerate else F.lit(False)
    return counted.withColumn("actual", actual).select(
        period,
        "feature",
        F.when(flag, 0.0).otherwise(_psi_value(F.col("actual"), F.col("expected"))).alias("psi"),
        flag.alias("degenerate"),
    )


def _psi_value(counts: Column, expected: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda acc, c: acc + c)
    shares = F.transform(counts, lambda c: F.greatest(c / total, F.lit(PSI_FLOOR)))
    terms = F.zip_with(shares, expected, lambda a, e: (a - e) * F.log(a / e))
    return F.when(total > 0, F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t))


def ks_by_period(
    reference: DataFrame, current: DataFrame, score: str, period: str, periods: Sequence
) -> DataFrame:
    """Two-sample KS of each period's scores against the reference, with p-value."""
    found = tagged_metrics(score_counts(reference, score), score_counts(current, score, tags=[period]), period, periods, 0.0)
    return found.select(period, "n_ref", "n_cur", "ks_stat").withColumn(
        "ks_pval", kolmogorov_p(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur"))
    )


def psi_band(value: Column) -> Column:
    """stable under 0.10, watch up to 0.20, shifted above."""
    return F.when(value < PSI_WATCH, "stable").when(value <= PSI_ALERT, "watch").when(value > PSI_ALERT, "shifted")


def drift_report(
    reference: DataFrame | None,
    current: DataFrame,
    key: str,
    score: str,
    label: str,
    features: Sequence[str],
    n_batches: int = 4,
    tau: float = 0.12,
    psi_reference: Sequence[PsiReference] | None = None,
    score_reference: DataFrame | None = None,
) -> DataFrame:
    """One row per ordered batch: size, AUC, rates, KS, PSI map, mean PSI, alert.

    All batches come from the same few passes, their scores and the
    reference's from one ordering; batch numbers start at 1. The mean PSI
    includes degenerate features as 0. ``psi_reference`` takes bins and
    ``score_reference`` score counts made earlier; with both the reference
    itself is not read.
    """
    batched = ordered_batches(current, key, n_batches).withColumn("batch", F.col("batch") + 1)
    fitted = psi_reference if psi_reference is not None else fit_psi_reference(reference, features)
    scores = score_reference if score_reference is not None else score_counts(reference, score)
    return report_periods(
        scores, score_counts(batched, score, label, ["batch"]), psi(fitted, batched, "batch"), "batch", range(1, n_batches + 1), tau
    )


def report_periods(
    reference: DataFrame, counts: DataFrame, shifts: DataFrame, period: str, periods: Sequence, tau: float
) -> DataFrame:
    """The report from score counts of the reference and of each period, and the periods' PSI per feature."""
    quality = tagged_metrics(reference, counts, period, periods, tau).where("n > 0")
    by_feature = F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "psi"))))
    means = shifts.groupBy(period).agg(F.avg("psi").alias("mean_psi"), by_feature.alias("psi_by_feature"))
    far = F.coalesce(F.col("mean_psi") > PSI_ALERT, F.lit(False)) | F.coalesce(F.col("ks_stat") > KS_ALERT, F.lit(False))
    return quality.join(means, period, "left").select(
        period,
        F.col("n").alias("n_rows"),
        "auc_roc",
        (F.col("flagged_n") / F.col("n")).alias("flag_rate"),
        (F.col("n_positive") / F.col("n")).alias("pos_rate"),
        "ks_stat",
        kolmogorov_p(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur")).alias("ks_pval"),
        F.coalesce("mean_psi", F.lit(0.0)).alias("mean_psi"),
        "psi_by_feature",
        far.alias("drift_alert"),
    )


def round_report(report: DataFrame, digits: int = 4) -> DataFrame:
    """Report figures rounded for output, map values included."""
    cols = ["auc_roc", "flag_rate", "pos_rate", "ks_stat", "ks_pval", "mean_psi"]
    return report.withColumns(
        {
            **{c: F.round(c, digits) for c in cols},
            "psi_by_feature": F.transform_values("psi_by_feature", lambda _, v: F.round(v, digits)),
        }
    )


def drift_alerts(report: DataFrame) -> DataFrame:
    """Alert flag, PSI band and the features above the watch level per batch."""
    return report.select(
        "batch",
        "drift_alert",
        psi_band(F.col("mean_psi")).alias("psi_band"),
        F.array_sort(F.map_keys(F.map_filter("psi_by_feature", lambda _, v: v > PSI_WATCH))).alias("psi_flags"),
    )


def psi_matrix(report: DataFrame, batches: Sequence[int]) -> DataFrame:
    """Feature rows against batch columns."""
    long = report.select("batch", F.explode("psi_by_feature").alias("feature", "psi"))
    return long.groupBy("feature").agg(
        *[F.max(F.when(F.col("batch") == b, F.col("psi"))).alias(f"batch_{b}") for b in batches]
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """Largest KS and PSI, number of alerts and the AUC change first to last."""
    worst = F.array_max(F.map_values("psi_by_feature"))
    return report.agg(
        F.count("*").alias("n_batches"),
        F.max("ks_stat").alias("max_ks"),
        F.max_by("batch", "ks_stat").alias("max_ks_batch"),
        F.max("mean_psi").alias("max_mean_psi"),
        F.max(worst).alias("max_feature_psi"),
        F.count_if("drift_alert").alias("n_alerts"),
        (F.max_by("auc_roc", "batch") - F.min_by("auc_roc", "batch")).alias("auc_change"),
    )
