"""Profiling statistics: missingness, dominance, contingency, rank correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.stats import chi2_upper
from tallyward.operators.ordered import exact_quantiles, running_totals


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], as_type: str) -> DataFrame:
    """One row per (row, column): ids, ``variable``, ``value``; NULL values dropped."""
    typed = df.select(*ids, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return typed.unpivot(list(ids), list(cols), "variable", "value").where("value IS NOT NULL")


def outcome_share(df: DataFrame, col: str) -> DataFrame:
    """Count and share of the total per value."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / df.agg(F.count("*")).scalar())


def two_way_share(df: DataFrame, group: str, col: str) -> DataFrame:
    """Count per (group, value) with the share inside the group.

    Group sizes come from their own aggregate instead of a window, so a group
    with very many values is never gathered in one task.
    """
    counts = df.groupBy(group, col).agg(F.count("*").alias("n"))
    sizes = df.groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("__t"))
    joined = counts.join(sizes, F.col(group).eqNullSafe(F.col("__g")))
    return joined.select(group, col, "n", (F.col("n") / F.col("__t")).alias("share"))


def missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count and share for columns with any NULL, most missing first.

    One aggregate over the table, no shuffle of rows.
    """
    cols = list(cols or df.columns)
    row = df.agg(
        F.count("*").alias("total"),
        F.array(
            *[F.struct(F.lit(c).alias("variable"), F.count_if(F.col(c).isNull()).alias("n_missing")) for c in cols]
        ).alias("rows"),
    )
    return (
        row.select("total", F.inline("rows"))
        .where("n_missing > 0")
        .select("variable", "n_missing", (F.col("n_missing") / F.col("total")).alias("pct_missing"))
        .orderBy(F.desc("n_missing"), "variable")
    )


def near_zero_variance(df: DataFrame, cols: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Columns whose most common non-NULL value exceeds the share threshold.

    A value holding more than half of a column always leads the frequent-item
    sketch, so one pass names a candidate per column and a second pass counts
    it exactly. No row is exploded or shuffled.
    """
    if threshold < 0.5:
        raise ValueError("the threshold must be at least 0.5")
    lead = df.agg(
        F.array(
            *[
                F.expr(f"get(approx_top_k(CAST(`{c}` AS STRING), 1) FILTER (WHERE `{c}` IS NOT NULL), 0).item")
                for c in cols
            ]
        ).alias("lead")
    ).scalar()
    row = df.withColumn("__lead", lead).agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("variable"),
                    F.count_if(F.col(c).cast("string") == F.get("__lead", F.lit(i))).alias("n_dominant"),
                    F.count(c).alias("n_present"),
                )
                for i, c in enumerate(cols)
            ]
        ).alias("rows")
    )
    return (
        row.select(F.inline("rows"))
        .withColumn("dominant_share", F.when(F.col("n_present") > 0, F.col("n_dominant") / F.col("n_present")))
        .where(F.col("dominant_share") > threshold)
        .select("variable", "dominant_share")
        .orderBy(F.desc("dominant_share"), "variable")
    )


def status_counts(df: DataFrame, cols: Sequence[str], exclude_value: str) -> DataFrame:
    """Counts of every other status per column, with the share inside the column."""
    long = to_long(df, [], cols, "string").where(F.col("value") != exclude_value)
    return two_way_share(long.withColumnRenamed("value", "status"), "variable", "status")


def histogram_by_label(df: DataFrame, cols: Sequence[str], label: str, bins: int = 30) -> DataFrame:
    """Equal-width counts per column and label over each column's own range.

    Ranges come from one aggregate and reach the rows as a scalar subquery.
    """
    spans = df.agg(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                              for c in cols]).alias("s")).scalar()
    ranged = df.withColumn("__s", spans)
    binned = {}
    for c in cols:
        lo, hi = F.col(f"__s.{c}.lo"), F.col(f"__s.{c}.hi")
        cell = F.floor((F.col(c) - lo) / (hi - lo) * bins)
        binned[c] = F.when(F.col(c).isNotNull(), F.when(hi > lo, F.least(cell, F.lit(bins - 1))).otherwise(0))
    wide = ranged.select(label, *[e.cast("int").alias(c) for c, e in binned.items()])
    long = wide.unpivot([label], list(cols), "variable", "bin").where("bin IS NOT NULL")
    return long.groupBy("variable", label, "bin").agg(F.count("*").alias("n"))


def _stratum_counts(stratum: str, strata: Sequence) -> dict[str, Column]:
    return {f"n_{s}": F.count_if(F.col(stratum) == s) for s in strata}


def table1_categorical(df: DataFrame, cols: Sequence[str], stratum: str, strata: Sequence) -> DataFrame:
    """Counts and percentages overall and per stratum, with a chi-square test.

    Output: variable, level, ``n``/``pct`` overall, ``n_<s>``/``pct_<s>`` per
    stratum, ``chi2``, ``dof``, ``p_value`` (Yates-corrected for 2 x 2).
    """
    long = to_long(df, [stratum], cols, "string").where(F.col(stratum).isin(*strata))
    levels = long.groupBy("variable", F.col("value").alias("level")).agg(
        F.count("*").alias("n"), *[e.alias(n) for n, e in _stratum_counts(stratum, strata).items()]
    )
    names = [f"n_{s}" for s in strata]
    # sums per variable: a row per column of the table
    totals = levels.groupBy("variable").agg(
        F.sum("n").alias("t"), F.count("*").alias("k"), *[F.sum(n).alias(f"t_{n}") for n in names]
    )
    with_t = levels.join(totals, "variable")
    two_by_two = (F.col("k") == 2) & F.lit(len(strata) == 2)
    cell_chi = F.lit(0.0)
    for n in names:
        expected = F.col("n") * F.col(f"t_{n}") / F.col("t")
        gap = F.abs(F.col(n) - expected)
        gap = F.when(two_by_two, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        cell_chi = cell_chi + F.when(expected > 0, gap * gap / expected).otherwise(0.0)
    tests = (
        with_t.groupBy("variable")
        .agg(F.sum(cell_chi).alias("chi2"), ((F.count("*") - 1) * (len(strata) - 1)).alias("dof"))
        .withColumn("p_value", F.when(F.col("dof") > 0, chi2_upper(F.col("chi2"), F.col("dof"))))
    )
    return with_t.join(tests, "variable").select(
        "variable",
        "level",
        "n",
        (100 * F.col("n") / F.col("t")).alias("pct"),
        *[c for n, s in zip(names, strata) for c in (F.col(n), (100 * F.col(n) / F.col(f"t_{n}")).alias(f"pct_{s}"))],
        "chi2",
        "dof",
        "p_value",
    )


def table1_continuous(df: DataFrame, cols: Sequence[str], stratum: str, strata: Sequence) -> DataFrame:
    """Median and quartiles overall and per stratum, with a Kruskal-Wallis test.

    One running total over (variable, value) serves every quantile and the
    rank sums, so the data is ordered once.
    """
    long = to_long(df, [stratum], cols, "double").where(F.col(stratum).isin(*strata))
    measures = {"n": F.count("*"), **_stratum_counts(stratum, strata)}
    cum = running_totals(long, "value", measures, ["variable"])
    sizes = long.groupBy("variable").agg(*[e.alias(f"t_{n}") for n, e in measures.items()])
    joined = cum.join(sizes, "variable")

    aggs = []
    for n in measures:
        suffix = n[1:]  # '' overall, '_<s>' per stratum
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            pos = F.lit(p) * (F.col(f"t_{n}") - 1)

            def at(position: Column) -> Column:
                hit = (position < F.col(f"cum_{n}")) & (position >= F.col(f"cum_{n}") - F.col(n))
                return F.max(F.when(hit, F.col("value")))

            low, high = at(F.floor(pos)), at(F.ceil(pos))
            aggs.append((low + F.max(pos - F.floor(pos)) * (high - low)).alias(name + suffix))
    avg_rank = F.col("cum_n") - (F.col("n") - 1) / 2
    ties = F.sum(F.pow(F.col("n").cast("double"), F.lit(3.0)) - F.col("n"))
    rank_sums = [F.sum(F.col(f"n_{s}") * avg_rank).alias(f"__r_{s}") for s in strata]
    per_var = joined.groupBy("variable").agg(
        *aggs, *rank_sums, ties.alias("__ties"), F.max("t_n").alias("__t"),
        *[F.max(f"t_n_{s}").alias(f"__t_{s}") for s in strata],
    )
    t = F.col("__t").cast("double")
    spread = F.lit(0.0)
    groups = F.lit(0)
    for s in strata:
        size = F.col(f"__t_{s}")
        spread = spread + F.when(size > 0, F.pow(F.col(f"__r_{s}"), F.lit(2.0)) / size).otherwise(0.0)
        groups = groups + F.when(size > 0, 1).otherwise(0)
    h = (12 / (t * (t + 1)) * spread - 3 * (t + 1)) / (1 - F.col("__ties") / (t * t * t - t))
    out = per_var.withColumn("h", F.when(F.col("__ties") < t * t * t - t, h)).withColumn("dof", groups - 1)
    return out.withColumn("p_value", chi2_upper(F.col("h"), F.col("dof"))).drop(
        "__ties", "__t", *[f"__t_{s}" for s in strata], *[f"__r_{s}" for s in strata]
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Count, balanced weight n / (2 n_c) and negative-to-positive ratio per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = df.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    ).scalar()
    return counts.withColumn("t", totals).select(
        label,
        "n",
        (F.col("t.n") / (2 * F.col("n"))).alias("weight"),
        F.when(F.col("t.pos") > 0, F.col("t.neg") / F.col("t.pos")).alias("neg_pos_ratio"),
    )


def with_class_weight(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Balanced weight attached to every row, without a join."""
    totals = df.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    ).scalar()
    size = F.when(F.col(label) == 1, F.col("__t.pos")).otherwise(F.col("__t.neg"))
    return df.withColumn("__t", totals).withColumn(out, F.col("__t.n") / (2 * size)).drop("__t")


def score_overlap(df: DataFrame, group: str, score: str, bins: int = 20) -> DataFrame:
    """Binned score counts on [0, 1] per group, next to the group's median."""
    valid = df.where(F.col(group).isNotNull() & F.col(score).isNotNull())
    cell = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    counts = valid.groupBy(group, cell.alias("bin")).agg(F.count("*").alias("n"))
    medians = exact_quantiles(valid, score, [0.5], [group]).select(group, F.get("quantiles", F.lit(0)).alias("median"))
    return counts.join(medians, group)


def mean_abs_ranked(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean absolute value per column, largest first, ranked from 1."""
    row = df.agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.avg(F.abs(F.col(c))).alias("mean_abs")) for c in cols]).alias("r"))
    long = row.select(F.inline("r"))
    # one row per column of the table: a plain window is the right size here
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("mean_abs"), "feature"))
    return long.withColumn("rank", rank)


def treated_share(df: DataFrame, flag: str) -> DataFrame:
    """Treated and control counts with their share."""
    return df.agg(
        F.count_if(F.col(flag) == 1).alias("n_treated"),
        F.avg((F.col(flag) == 1).cast("int")).alias("treated_share"),
        F.count_if(F.col(flag) == 0).alias("n_control"),
        F.avg((F.col(flag) == 0).cast("int")).alias("control_share"),
    )


def top_k(df: DataFrame, by: Column, k: int, *ties: str) -> DataFrame:
    """Report of the k first rows in the given order."""
    return df.orderBy(by, *ties).limit(k)
