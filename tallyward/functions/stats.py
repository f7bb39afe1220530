"""Closed-form distribution functions as column expressions.

They run on report rows (one per group), inside the same plan as the
aggregates that feed them, so no result has to pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart's rational approximation of the normal tail
# (Hart et al. 1968, algorithm 5666), highest power first.
HART_NUM = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
HART_DEN = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
HART_LIMIT = 7.07106781186547
SQRT_TWO_PI = 2.506628274631


def _horner(x: Column, coefs: Sequence[float]) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_upper(x: Column) -> Column:
    """P(Z > x) for a standard normal Z."""
    a = F.abs(x)
    e = F.exp(-a * a / 2)
    near = e * _horner(a, HART_NUM) / _horner(a, HART_DEN)
    frac = a + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        frac = a + F.lit(k) / frac
    far = e / frac / SQRT_TWO_PI
    tail = F.when(a > 37, 0.0).when(a < HART_LIMIT, near).otherwise(far)
    return F.when(x > 0, tail).otherwise(1 - tail)


def normal_cdf(x: Column) -> Column:
    return normal_upper(-x)


def normal_two_sided(z: Column) -> Column:
    return 2 * normal_upper(F.abs(z))


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p of a t statistic through its normal transform.

    Error is O(1/df^2), below the reported digits once df reaches hundreds.
    """
    z = t * (1 - 1 / (4 * df)) / F.sqrt(1 + t * t / (2 * df))
    return normal_two_sided(z)


def chi2_upper(x: Column, df: Column) -> Column:
    """P(chi-square with ``df`` > x) for whole ``df``: a finite sum.

    Even df: exp(-x/2) * sum (x/2)^i / i!. Odd df: the df=1 tail plus the same
    kind of sum over half-integers. Terms are carried as running products.
    """
    half = x / 2
    even = df % 2 == 0
    steps = F.floor((df - 1) / 2).cast("int")
    first = F.when(even, F.lit(1.0)).otherwise(F.sqrt(half) / F.lit(math.sqrt(math.pi) / 2))
    start = F.struct(
        F.when(even, F.lit(1.0)).when(steps >= 1, first).otherwise(F.lit(0.0)).alias("total"),
        first.alias("term"),
    )

    def add_term(acc: Column, i: Column) -> Column:
        shift = F.when(even, i.cast("double")).otherwise(i + F.lit(0.5))
        term = acc["term"] * half / shift
        return F.struct((acc["total"] + term).alias("total"), term.alias("term"))

    last = F.when(even, steps).otherwise(steps - 1)
    idx = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    # for odd df the i-th extra term divides by i + 1/2, for even df by i
    total = F.aggregate(idx, start, add_term)["total"]
    tail = F.when(half > 700, 0.0).otherwise(F.exp(-half) * total)
    p = F.when(even, tail).otherwise(normal_two_sided(F.sqrt(x)) + tail)
    return F.when(x <= 0, 1.0).otherwise(F.least(p, F.lit(1.0)))


def kolmogorov_p(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Large-sample p-value of a two-sample KS statistic."""
    lam = d * F.sqrt(n.cast("double") * m / (n + m))
    total = F.lit(0.0)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        total,
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    # below 0.2 the alternating series has not settled; the p-value is 1 there
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.least(2 * series, F.lit(1.0)), F.lit(0.0)))


def e_value(ratio: Column) -> Column:
    """Strength of unmeasured confounding that could explain a ratio away."""
    r = F.greatest(ratio, 1 / ratio)
    return r + F.sqrt(r * (r - 1))


def arcsine_effect(p1: Column, p2: Column) -> Column:
    """Cohen's h between two proportions."""
    return 2 * F.asin(F.sqrt(p1)) - 2 * F.asin(F.sqrt(p2))
