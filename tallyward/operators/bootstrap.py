"""Bootstrap of the doubly robust estimate, every replicate refitted.

All replicates share each pass over the data: a pass computes, per replicate,
the weighted normal equations of its current coefficients inside the tasks and
sums them across tasks. Resampling uses Poisson(1) row counts drawn from a
hash of (row key, replicate, seed), so the draw does not depend on how the
rows are partitioned and a lost task recomputes the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.causal import design_array
from tallyward.session import materialize

# Cumulative Poisson(1) probabilities for counts 0, 1, 2, ...
POISSON_CDF = np.cumsum([np.exp(-1.0) / float(np.prod(range(1, k + 1))) for k in range(12)])


def poisson_counts(hashes: np.ndarray, reps: int, seed: int) -> np.ndarray:
    """Row-by-replicate Poisson(1) counts from 64-bit row hashes (splitmix64)."""
    z = hashes.astype(np.uint64)[:, None] + (
        np.arange(1, reps + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    )
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z = z ^ (z >> np.uint64(31))
    u = (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(POISSON_CDF, u, side="right").astype(np.float64)


def _sums(df: DataFrame, part, width: int) -> dict[int, np.ndarray]:
    """Run ``part(pdf) -> (reps, width)`` over Arrow batches and add up everywhere.

    Tasks emit one row per replicate; the driver receives ``reps * width`` sums.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                s = part(pdf)
                total = s if total is None else total + s
        if total is not None:
            yield pd.DataFrame({"rep": np.arange(len(total)), "s": list(total)})

    partial = df.mapInPandas(run, "rep int, s array<double>")
    summed = partial.groupBy("rep").agg(Summarizer.sum(array_to_vector("s")).alias("v"))
    return {r["rep"]: np.array(r["s"]) for r in summed.select("rep", vector_to_array("v").alias("s")).collect()}


def _irls(
    df: DataFrame, x: str, y: str, reps: int, seed: int, p: int, max_iter: int, tol: float
) -> tuple[np.ndarray, np.ndarray]:
    """Logistic coefficients of every replicate, shape (reps, p), and which replicates came to rest."""
    beta = np.zeros((reps, p))
    rest = np.zeros(reps, bool)
    for _ in range(max_iter):
        current = beta.copy()

        def part(pdf: pd.DataFrame) -> np.ndarray:
            xs = np.vstack(pdf[x].to_numpy())
            ys = pdf[y].to_numpy(dtype=np.float64)
            counts = poisson_counts(pdf["h"].to_numpy(), reps, seed)
            eta = np.clip(xs @ current.T, -30, 30)
            mu = 1 / (1 + np.exp(-eta))
            w = counts * mu * (1 - mu)
            grad = xs.T @ (counts * (ys[:, None] - mu))
            outer = (xs[:, :, None] * xs[:, None, :]).reshape(len(xs), p * p)
            return np.hstack([w.T @ outer, grad.T])

        sums = _sums(df.select(x, y, "h"), part, p * p + p)
        rest[:] = True
        for rep, s in sums.items():
            step = np.linalg.lstsq(s[: p * p].reshape(p, p), s[p * p :], rcond=None)[0]
            beta[rep] += step
            rest[rep] = np.abs(step).max() < tol
        if rest.all():
            break
    return beta, rest


def bootstrap_aipw(
    df: DataFrame,
    key: str,
    treatment: str,
    outcome: str,
    covariates: Sequence[str],
    reps: int = 300,
    seed: int = 20240611,
    max_iter: int = 25,
    tol: float = 1e-6,
) -> DataFrame:
    """Replicate risk differences: rows ``(rep, risk_difference, converged)``.

    A replicate has not converged if one of its two fits still moved after ``max_iter`` steps.
    """
    x = design_array(df, treatment, covariates, "x").select(
        "x", F.col(treatment).cast("double").alias("a"), F.col(outcome).cast("double").alias("y"),
        F.xxhash64(key, F.lit(seed)).alias("h"),
    ).withColumn("xo", F.concat("x", F.array("a")))
    data = materialize(x, "bootstrap")
    p = len(data.select("x").first()["x"])
    ps_beta, ps_rest = _irls(data, "x", "a", reps, seed, p, max_iter, tol)
    out_beta, out_rest = _irls(data, "xo", "y", reps, seed, p + 1, max_iter, tol)

    def part(pdf: pd.DataFrame) -> np.ndarray:
        xs = np.vstack(pdf["x"].to_numpy())
        a, y = pdf["a"].to_numpy()[:, None], pdf["y"].to_numpy()[:, None]
        counts = poisson_counts(pdf["h"].to_numpy(), reps, seed)
        ps = 1 / (1 + np.exp(-np.clip(xs @ ps_beta.T, -30, 30)))
        base = xs @ out_beta[:, :p].T
        m1 = 1 / (1 + np.exp(-np.clip(base + out_beta[:, p], -30, 30)))
        m0 = 1 / (1 + np.exp(-np.clip(base, -30, 30)))
        d = (m1 + a / ps * (y - m1)) - (m0 + (1 - a) / (1 - ps) * (y - m0))
        return np.column_stack([(counts * d).sum(0), counts.sum(0)])

    sums = _sums(data.select("x", "a", "y", "h"), part, 2)
    settled = ps_rest & out_rest
    rows = [(int(r), float(s[0] / s[1]), bool(settled[r])) for r, s in sorted(sums.items())]
    return df.sparkSession.createDataFrame(rows, "rep int, risk_difference double, converged boolean")


def normal_interval(estimate: DataFrame, replicates: DataFrame, col: str = "risk_difference") -> DataFrame:
    """Estimate with bootstrap standard error and a 1.96-sd interval."""
    se = replicates.agg(F.stddev_samp(col)).scalar()
    return estimate.select(F.col(col).alias("estimate")).withColumn("std_error", se).withColumns(
        {
            "low": F.col("estimate") - 1.96 * F.col("std_error"),
            "high": F.col("estimate") + 1.96 * F.col("std_error"),
        }
    )
