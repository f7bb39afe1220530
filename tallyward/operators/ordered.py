"""Exact global ordering without a single-partition window.

``Window.orderBy`` without ``partitionBy`` moves every row to one task. Two
building blocks avoid that here:

``running_totals``
    Combine rows per (group, key), cut the key range into B buckets at
    approximate quantiles, run the window inside each (group, bucket) and add
    the total of the buckets before it. Bucket limits only balance the load;
    any limits give the same exact result. A hot key is one row after the
    combine step and a hot group is spread over all buckets.

``order_statistics``
    Exact value at a given position, found by bracketing: approximate
    quantiles give two values that surely enclose it, and only the keys
    between them are ordered. Rows are never shuffled, so splitting a wide
    table by position costs two column-pruned scans.
    It answers with a few literals, so plans built on it stay small however
    often they are reused.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 4096
SKETCH_ACCURACY = 20_000


def default_buckets(df: DataFrame) -> int:
    """Power of two at or above the session's shuffle partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, 1 << max(1, (parts - 1).bit_length()))


def with_bucket(
    df: DataFrame, key: str, limits: Column, buckets: int, out: str = "__bucket", inclusive: bool = False
) -> DataFrame:
    """Number of limits below the key, by binary search in log2(buckets) projections.

    ``limits`` is an ascending array of ``buckets - 1`` values, ``buckets`` a
    power of two. With ``inclusive`` a limit equal to the key counts too. The
    search is plain arithmetic on array lookups and stays inside whole-stage
    codegen.
    """
    df = df.withColumn("__limits", limits).withColumn(out, F.lit(0))
    step = buckets // 2
    while step:
        limit = F.get(F.col("__limits"), F.col(out) + F.lit(step - 1))
        above = F.col(key) >= limit if inclusive else F.col(key) > limit
        df = df.withColumn(out, F.col(out) + F.when(above, step).otherwise(0))
        step //= 2
    return df.drop("__limits")


def with_bin(df: DataFrame, key: str, edges: Sequence[float], out: str, inclusive: bool = False) -> DataFrame:
    """:func:`with_bucket` for a fixed ascending list of edges of any length."""
    buckets = 1 << len(edges).bit_length()
    padded = [float(e) for e in edges] + [float("inf")] * (buckets - 1 - len(edges))
    capped = F.least(F.col(out), F.lit(len(edges)))
    return with_bucket(df, key, F.array(*[F.lit(e) for e in padded]), buckets, out, inclusive).withColumn(out, capped)


def quantile_limits(df: DataFrame, key: str, buckets: int) -> Column:
    """Scalar subquery: ``buckets - 1`` approximate quantiles of the key.

    They only balance load, so a sketch with a tenth of a bucket's error does.
    """
    cuts = [i / buckets for i in range(1, buckets)]
    return df.agg(F.percentile_approx(key, cuts, max(200, 10 * buckets)).alias("l")).scalar()


def join_groups(left: DataFrame, right: DataFrame, groups: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Inner join on groups, where NULL equals NULL, and on plain keys; columns of ``right`` are not repeated."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in [*groups, *keys]})
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__r_{g}"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"__r_{k}"))
    return left.join(renamed, same).drop(*[f"__r_{c}" for c in [*groups, *keys]])


def running_totals(
    df: DataFrame,
    key: str,
    measures: Mapping[str, Column],
    groups: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    limits: Column | None = None,
    totals: bool = False,
) -> DataFrame:
    """Per distinct (groups, key): each measure and its inclusive running sum.

    ``measures`` maps a name to an additive aggregate such as ``F.count('*')``.
    The output holds groups, key, the measures and ``cum_<measure>``, summed
    along the key in the chosen direction. NULL is a group like any other.
    ``limits`` replaces the quantile sketch where the caller has one already.
    ``totals`` adds ``total_<measure>``, the sum of the whole group; it comes
    with the bucket offsets, so that no caller joins rows on the group alone.
    """
    groups = list(groups)
    buckets = buckets or default_buckets(df)
    combined = df.groupBy(*groups, key).agg(*[m.alias(n) for n, m in measures.items()])
    limits = limits if limits is not None else quantile_limits(df, key, buckets)
    bucketed = with_bucket(combined, key, limits, buckets)

    order = F.col(key).desc() if descending else F.col(key).asc()
    inside = (
        Window.partitionBy(*groups, "__bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = bucketed.withColumns({f"cum_{n}": F.sum(n).over(inside) for n in measures})

    # at most `buckets` rows per group, so this window is small by construction
    bucket_order = F.col("__bucket").desc() if descending else F.col("__bucket").asc()
    before = Window.partitionBy(*groups).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    group_totals = {f"total_{n}": F.sum(f"__t_{n}").over(whole) for n in measures} if totals else {}
    offsets = (
        bucketed.groupBy(*groups, "__bucket")
        .agg(*[F.sum(n).alias(f"__t_{n}") for n in measures])
        .withColumns({f"__o_{n}": F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)) for n in measures} | group_totals)
        .select(*groups, "__bucket", *[f"__o_{n}" for n in measures], *group_totals)
    )
    # no hint: the window already placed rows by (groups, bucket), and AQE
    # broadcasts the offsets only when their measured size allows it
    joined = join_groups(local, offsets, groups, ["__bucket"])
    return joined.select(
        *groups,
        key,
        *measures,
        *[(F.col(f"cum_{n}") + F.col(f"__o_{n}")).alias(f"cum_{n}") for n in measures],
        *group_totals,
    )


@dataclass(frozen=True)
class OrderStatistics:
    """Row count and the key at each requested position (None if out of range)."""

    n: int
    cuts: list


def order_statistics(
    df: DataFrame, key: str, targets: Sequence[tuple[float, Callable[[int], int]]]
) -> OrderStatistics:
    """Exact keys at given positions of the ascending order.

    A target is ``(fraction, position)``: ``position`` maps the row count to a
    zero-based position, ``fraction`` is where it lies, roughly
    ``position / n``. NULL keys take no part.

    Two jobs run, both scanning the key column alone. The first sketches the
    distribution. The second keeps the keys inside the brackets around each
    target, about 1e-3 of them, folds everything between brackets into one
    counted key, and orders that remainder across the cluster. The driver
    sees one value per target.
    """
    keyed = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    # the sketch is off by n / accuracy positions at most; the rest covers the
    # distance between a fraction and its rounded position
    margin = (5.0 + len(targets)) / SKETCH_ACCURACY
    buckets = default_buckets(df)
    points = max(2, buckets // max(1, len(targets)))
    grid = sorted(
        {
            min(1.0, max(0.0, f - margin + 2 * margin * i / points))
            for f, _ in targets
            for i in range(points + 1)
        }
    )
    row = keyed.agg(
        F.count("*").alias("n"),
        F.min("k").alias("lo"),
        F.max("k").alias("hi"),
        F.percentile_approx("k", grid, max(SKETCH_ACCURACY, 10 * buckets)).alias("q"),
    ).first()
    n = row["n"]
    positions = [p(n) for _, p in targets]
    valid = sorted({p for p in positions if 0 <= p < n})
    if not valid:
        return OrderStatistics(n, [None] * len(targets))

    at = dict(zip(grid, row["q"]))

    def edge(q: float, end: float):
        # few rows: rounding outweighs the margin, so order all keys
        if n <= SKETCH_ACCURACY or q == end:
            return row["lo"] if end == 0.0 else row["hi"]
        return at[q]

    brackets = sorted(
        (edge(max(0.0, f - margin), 0.0), edge(min(1.0, f - margin + 2 * margin), 1.0)) for f, _ in targets
    )
    merged = [brackets[0]]
    for lo, hi in brackets[1:]:
        if lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))

    k = F.col("k")
    inside = F.lit(False)
    folded = F.lit(row["lo"])
    for lo, hi in merged:
        within = (k >= F.lit(lo)) & (k <= F.lit(hi))
        inside = inside | within
        folded = F.when(within, k).when(k > F.lit(hi), F.lit(hi)).otherwise(folded)
    slim = keyed.select(folded.alias("v"), inside.alias("inside"))
    cum = running_totals(
        slim,
        "v",
        {"n": F.count("*"), "m": F.count_if("inside")},
        buckets=buckets,
        limits=_limit_array(row["q"], buckets),
    )
    start = F.col("cum_n") - F.col("n")
    hit = F.filter(F.array(*[F.lit(p) for p in valid]), lambda p: (p >= start) & (p < start + F.col("m")))
    found = {p: r["v"] for r in cum.withColumn("p", hit).where(F.size("p") > 0).select("v", "p").collect() for p in r["p"]}
    if missing := [p for p in valid if p not in found]:
        raise RuntimeError(f"positions {missing} lie outside their brackets")
    return OrderStatistics(n, [found.get(p) for p in positions])


def _limit_array(values: Sequence, buckets: int) -> Column:
    """Ascending literal limits, thinned or padded to ``buckets - 1`` entries."""
    distinct = sorted(set(values))
    wanted = buckets - 1
    if len(distinct) > wanted:
        distinct = [distinct[i * len(distinct) // wanted] for i in range(wanted)]
    distinct += [distinct[-1]] * (wanted - len(distinct))
    return F.array(*[F.lit(v) for v in distinct])


def cut_index(key: str, cuts: Sequence) -> Column:
    """Number of cuts below the key; a missing cut (position -1) is below every key."""
    total = F.lit(0)
    for cut in cuts:
        total = total + (F.lit(1) if cut is None else F.when(F.col(key) > F.lit(cut), 1).otherwise(0))
    return total


def fraction_split(
    df: DataFrame,
    key: str,
    labels: Sequence[tuple[str, float]],
    last: str,
    out: str = "split_group",
) -> DataFrame:
    """Label rows by percent rank of the key: below each limit, else ``last``.

    Percent rank is (rank - 1) / (n - 1), 0 for a single row. A row is below
    limit f exactly when fewer than ``t`` keys are smaller, ``t`` being the
    first count whose ratio reaches f, that is when its key is at most the key
    at position t - 1. Ties therefore stay together. A NULL key sorts last.

    The labels become plain comparisons with literals: no row is shuffled.
    """

    def position(limit: float) -> Callable[[int], int]:
        def at(n: int) -> int:
            span = max(n - 1, 1)
            first = math.ceil(limit * span)
            # the product may round across a whole number: settle by division
            while first > 0 and (first - 1) / span >= limit:
                first -= 1
            while first / span < limit:
                first += 1
            return min(first, n) - 1

        return at

    stats = order_statistics(df, key, [(limit, position(limit)) for _, limit in labels])
    label = F.lit(last)
    for (name, _), cut in reversed(list(zip(labels, stats.cuts))):
        below = F.lit(False) if cut is None else F.col(key) <= F.lit(cut)
        label = F.when(below, name).otherwise(label)
    return df.withColumn(out, label)


def ordered_batches(df: DataFrame, key: str, n_batches: int, out: str = "batch") -> DataFrame:
    """Equal batches in key order, 0-based; the last one takes the remainder.

    ``key`` must be unique and not NULL. With fewer rows than batches each
    batch but the last is empty.
    """
    targets = [(i / n_batches, lambda n, i=i: n // n_batches * i - 1) for i in range(1, n_batches)]
    cuts = order_statistics(df, key, targets).cuts if targets else []
    return df.withColumn(out, cut_index(key, cuts))


def global_rank(df: DataFrame, key: str, groups: Sequence[str] = ()) -> DataFrame:
    """Per distinct key: count, rank (1 = smallest, ties share) and average rank."""
    ranked = running_totals(df, key, {"n": F.count("*")}, groups)
    return ranked.select(
        *groups,
        key,
        "n",
        (F.col("cum_n") - F.col("n") + 1).alias("rank"),
        (F.col("cum_n") - (F.col("n") - 1) / 2).alias("avg_rank"),
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles per group, one array column ``quantiles``.

    Same result as the built-in ``percentile``, which keeps a map of all
    distinct values in one task; here that map is spread over the cluster.
    """
    groups = list(groups)
    present = df.where(F.col(value).isNotNull())
    cum = running_totals(present, value, {"n": F.count("*")}, groups, totals=True)
    aggs = []
    for p in probs:
        pos = F.lit(p) * (F.col("total_n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)

        def at(position: Column) -> Column:
            hit = (position < F.col("cum_n")) & (position >= F.col("cum_n") - F.col("n"))
            return F.max(F.when(hit, F.col(value).cast("double")))

        share = F.max(pos - lo)
        aggs.append(at(lo) + share * (at(hi) - at(lo)))
    return cum.groupBy(*groups).agg(F.array(*aggs).alias("quantiles"))


def ecdf_grid(df: DataFrame, value: str, grid_start: float, grid_end: float, points: int,
              groups: Sequence[str] = ()) -> DataFrame:
    """Share of values at or below each of ``points`` equally spaced grid values.

    Values are first counted per grid cell, so the running sum sees at most
    ``points`` rows per group.
    """
    groups = list(groups)
    step = (grid_end - grid_start) / (points - 1)
    grid = df.sparkSession.range(points).select(
        F.col("id").cast("int").alias("cell"), (F.lit(grid_start) + F.col("id") * F.lit(step)).alias("x")
    )
    v = F.col(value)
    guess = F.greatest(F.ceil((v - grid_start) / F.lit(step)), F.lit(0))
    at = lambda c: F.lit(grid_start) + c * F.lit(step)  # noqa: E731 - same expression as the grid
    cell = F.when((guess > 0) & (at(guess - 1) >= v), guess - 1).when(at(guess) >= v, guess).otherwise(guess + 1)
    counts = (
        df.where(v.isNotNull())
        .select(*groups, F.least(cell, F.lit(points)).cast("int").alias("cell"))
        .groupBy(*groups, "cell")
        .agg(F.count("*").alias("c"))
    )
    if groups:
        axis = counts.select(*groups).distinct().withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(points))))
        dense = axis.join(counts, [*groups, "cell"], "left")
    else:
        axis = df.sparkSession.range(points + 1).select(F.col("id").cast("int").alias("cell"))
        dense = axis.join(counts, "cell", "left")
    upto = Window.partitionBy(*groups).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*groups)
    shares = dense.select(
        *groups,
        "cell",
        (F.sum(F.coalesce("c", F.lit(0))).over(upto) / F.sum(F.coalesce("c", F.lit(0))).over(whole)).alias("cdf"),
    )
    return shares.join(grid, "cell").select(*groups, "x", "cdf")
