"""Experiment design arithmetic on scored cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.stats import arcsine_effect, normal_cdf
from tallyward.operators.ordered import running_totals

# Standard normal quantiles for the usual levels.
Z_ALPHA = {0.05: 1.959963984540054, 0.01: 2.5758293035489004}
Z_POWER = {0.8: 0.8416212335729143, 0.9: 1.2815515655446004}


def enrolment_sweep(sweep: DataFrame) -> DataFrame:
    """Threshold sweep rows read as enrolment: who is flagged, at what baseline risk."""
    keep = [c for c in sweep.columns if c not in ("flagged_n", "flagged_rate", "precision_tau", "recall_tau", "f1_tau")]
    return sweep.select(
        *keep,
        F.col("flagged_n").alias("n_flagged"),
        F.col("flagged_rate").alias("pct_flagged"),
        F.when(F.col("flagged_n") > 0, F.col("precision_tau")).alias("baseline_risk"),
    )


def _grid(df: DataFrame, name: str, values: Sequence[float]) -> DataFrame:
    """Every row once per parameter value."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def effect_scenarios(segments: DataFrame, risk: str, arrs: Sequence[float]) -> DataFrame:
    """Relative reduction and treated rate for each absolute reduction."""
    p = F.col(risk)
    return _grid(segments, "arr", arrs).withColumns(
        {"rrr": F.when(p > 0, F.col("arr") / p), "p_control": p, "p_treatment": p - F.col("arr")}
    )


def sample_size(segments: DataFrame, risk: str, arrs: Sequence[float], alphas: Sequence[float], powers: Sequence[float]) -> DataFrame:
    """Rows per arm for a two-sided test of two proportions (arcsine effect size).

    Reductions that would push the treated rate below 0 are left out.
    """
    z_a = F.create_map(*[F.lit(x) for a in alphas for x in (a, Z_ALPHA[a])])
    z_b = F.create_map(*[F.lit(x) for b in powers for x in (b, Z_POWER[b])])
    grid = _grid(_grid(_grid(segments, "alpha", alphas), "power", powers), "arr", arrs)
    grid = grid.where(F.col(risk) - F.col("arr") >= 0)
    h = arcsine_effect(F.col(risk), F.col(risk) - F.col("arr"))
    z = F.element_at(z_a, F.col("alpha")) + F.element_at(z_b, F.col("power"))
    n = F.ceil(2 * (z / h) * (z / h))
    return grid.withColumn("n_per_arm", n).withColumn("n_total", 2 * F.col("n_per_arm"))


def power_curve(segments: DataFrame, risk: str, arrs: Sequence[float], sizes: tuple[int, int, int], alpha: float = 0.05) -> DataFrame:
    """Power for each reduction over sizes (first, last, step)."""
    grid = _grid(segments, "arr", arrs).where(F.col(risk) - F.col("arr") >= 0)
    grid = grid.withColumn("n_per_arm", F.explode(F.sequence(*[F.lit(s) for s in sizes])))
    h = F.abs(arcsine_effect(F.col(risk), F.col(risk) - F.col("arr")))
    return grid.withColumn("power", normal_cdf(h * F.sqrt(F.col("n_per_arm") / 2) - F.lit(Z_ALPHA[alpha])))


def feasibility(sizes: DataFrame, pct_flagged: str, annual: int) -> DataFrame:
    """Yearly enrolment per arm and years needed to reach the sample size."""
    flagged = F.round(F.lit(annual) * F.col(pct_flagged)).cast("long")
    per_arm = F.floor(F.col("annual_flagged") / 2)
    return (
        sizes.withColumn("annual_flagged", flagged)
        .withColumn("annual_per_arm", per_arm)
        .withColumn("years_required", F.when(F.col("annual_per_arm") > 0, F.round(F.col("n_per_arm") / F.col("annual_per_arm"), 1)))
    )


def block_randomize(df: DataFrame, key: str, strata: Sequence[str], block: int = 4, seed: int = 1) -> DataFrame:
    """Stratified permuted blocks, 1:1 inside each block.

    Rows are numbered in key order per stratum with the two-level order, so a
    stratum may hold any share of the rows; a block is ``block`` neighbours,
    ordered by a seeded hash, of which the first half is treated.
    """
    if block % 2:
        raise ValueError("the block size must be even")
    numbered = running_totals(df, key, {"one": F.count("*")}, strata).select(
        *strata, key, F.floor((F.col("cum_one") - 1) / block).alias("block")
    )
    shuffled = F.md5(F.concat_ws(":", F.col(key), F.lit(seed)))
    order = Window.partitionBy(*strata, "block").orderBy(shuffled, F.col(key))
    return numbered.withColumn("arm", F.when(F.row_number().over(order) <= block // 2, 1).otherwise(0))


def interim_looks(df: DataFrame, look: str, arm: str, outcome: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative two-arm z statistic at each look against given boundaries.

    ``look`` numbers the interval a row arrived in from 1; one row per look
    remains after the aggregate, so the running sum is over a handful of rows.
    """
    a, y = F.col(arm), F.col(outcome)
    per_look = df.groupBy(look).agg(
        F.count_if(a == 1).alias("n1"),
        F.count_if(a == 0).alias("n0"),
        F.sum(F.when(a == 1, y).otherwise(0)).alias("y1"),
        F.sum(F.when(a == 0, y).otherwise(0)).alias("y0"),
    )
    upto = Window.partitionBy(F.lit(1)).orderBy(look).rowsBetween(Window.unboundedPreceding, 0)
    cum = per_look.select(look, *[F.sum(c).over(upto).alias(c) for c in ("n1", "n0", "y1", "y0")])
    p1, p0 = F.col("y1") / F.col("n1"), F.col("y0") / F.col("n0")
    pooled = (F.col("y1") + F.col("y0")) / (F.col("n1") + F.col("n0"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n1") + 1 / F.col("n0")))
    bound = F.get(F.array(*[F.lit(float(b)) for b in bounds]), F.col(look) - 1)
    z: Column = F.when(se > 0, (p1 - p0) / se)
    out = cum.withColumn("z", z).withColumn("bound", bound)
    return out.withColumn("crossed", F.coalesce(F.abs(F.col("z")) >= F.col("bound"), F.lit(False)))
