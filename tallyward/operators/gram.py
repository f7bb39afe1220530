"""Figures of every column pair from blocks of rows, without a row per pair.

``spearman``: each column's ranks are made once, and once more per column with
missing values, because a pair ranks its complete rows only. Rows then carry
their ranks, and a task adds up the products of all pairs over blocks of rows.
``pair_counts``: a task counts the joint levels of all pairs in a block; what
is shuffled are cells with counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.ordered import running_totals
from tallyward.session import materialize


def _rank_table(df: DataFrame, cols: Sequence[str], partial: Sequence[str]) -> DataFrame:
    """(variable, value, ranks): average rank of each value among all rows, then among those where each partial column is present."""
    present = [F.col(c).isNotNull().alias(f"has_{i}") for i, c in enumerate(partial)]
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols], *present)
    long = wide.unpivot([f"has_{i}" for i in range(len(partial))] or [F.lit(1).alias("one")], list(cols), "variable", "value").where("value IS NOT NULL")
    measures = {"n": F.count("*")} | {f"n{i}": F.count_if(f"has_{i}") for i in range(len(partial))}
    cum = running_totals(long, "value", measures, ["variable"])
    ranks = [F.when(F.col(m) > 0, F.col(f"cum_{m}") - (F.col(m) - 1) / 2) for m in measures]
    return cum.select("variable", "value", F.array(*ranks).cast("array<double>").alias("ranks"))


def _ranks_of(column: pa.Array, width: int) -> np.ndarray:
    """rows x width matrix of a list column; missing entries are NaN."""
    out = np.full((len(column), width), np.nan)
    given = np.asarray(column.is_valid())
    if given.any():
        flat = column.drop_null().flatten()
        out[given] = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman correlation (var1, var2, rho) of every column pair over pairwise complete rows; NULL without variation."""
    cols = list(cols)
    pairs = list(combinations(range(len(cols)), 2))
    slim = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "rank-columns")
    both = [F.count_if(F.col(cols[i]).isNotNull() & F.col(cols[j]).isNotNull()) for i, j in pairs]
    sizes = slim.agg(F.count("*"), *[F.count(c) for c in cols], *both).first()
    n, counts, common = sizes[0], sizes[1 : 1 + len(cols)], sizes[1 + len(cols) :]
    partial = [c for c, k in zip(cols, counts) if k < n]
    place = {c: partial.index(c) + 1 if c in partial else 0 for c in cols}
    table = materialize(_rank_table(slim, cols, partial), "ranks")
    ranked = slim
    for c in cols:
        own = table.where(F.col("variable") == c).select(F.col("value").alias("__v"), F.col("ranks").alias(f"r_{c}"))
        ranked = ranked.join(own, F.col(c) == F.col("__v"), "left").drop("__v")
    width = 1 + len(partial)
    middle = [(k + 1) / 2 for k in common]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(pairs), 3))
        for batch in batches:
            of = [_ranks_of(batch.column(f"r_{c}"), width) for c in cols]
            for k, (i, j) in enumerate(pairs):
                a = of[i][:, place[cols[j]]] - middle[k]
                b = of[j][:, place[cols[i]]] - middle[k]
                whole = ~(np.isnan(a) | np.isnan(b))
                a, b = a[whole], b[whole]
                sums[k] += a @ b, a @ a, b @ b
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(pairs), dtype=np.int32)), *(pa.array(np.ascontiguousarray(x)) for x in sums.T)], ["pair", "sab", "saa", "sbb"]
        )

    added = (
        ranked.select(*[f"r_{c}" for c in cols])
        .mapInArrow(products, "pair int, sab double, saa double, sbb double")
        .groupBy("pair")
        .agg(*[F.sum(c).alias(c) for c in ("sab", "saa", "sbb")])
    )
    names = [F.array(*[F.lit(cols[p[side]]) for p in pairs]) for side in (0, 1)]
    seen = F.get(F.array(*[F.lit(k > 0) for k in common]), F.col("pair"))
    # products of ranks are sums of quarters: anything under one is no variation
    varied = (F.col("saa") > 0.1) & (F.col("sbb") > 0.1)
    return added.where(seen).select(
        F.get(names[0], F.col("pair")).alias("var1"),
        F.get(names[1], F.col("pair")).alias("var2"),
        F.when(varied, F.col("sab") / F.sqrt(F.col("saa") * F.col("sbb"))).alias("rho"),
    )


def pair_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Joint counts (var1, var2, a, b, n) of every pair of columns as text, complete pairs only."""
    cols = list(cols)
    pairs = list(combinations(range(len(cols)), 2))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [batch.column(c).dictionary_encode() for c in cols]
            levels = [c.dictionary for c in coded]
            codes = [c.indices.fill_null(-1).to_numpy().astype(np.int64) for c in coded]
            pair, left, right, n = [], [], [], []
            for k, (i, j) in enumerate(pairs):
                whole = (codes[i] >= 0) & (codes[j] >= 0)
                width = max(len(levels[j]), 1)
                found, times = np.unique(codes[i][whole] * width + codes[j][whole], return_counts=True)
                pair.append(np.full(len(found), k, np.int32))
                left.append(levels[i].take(pa.array(found // width)))
                right.append(levels[j].take(pa.array(found % width)))
                n.append(times.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(pair)), pa.concat_arrays(left), pa.concat_arrays(right), pa.array(np.concatenate(n))],
                ["pair", "a", "b", "n"],
            )

    typed = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    counted = typed.mapInArrow(cells, "pair int, a string, b string, n long").groupBy("pair", "a", "b").agg(F.sum("n").alias("n"))
    names = [F.array(*[F.lit(cols[p[side]]) for p in pairs]) for side in (0, 1)]
    return counted.select(F.get(names[0], F.col("pair")).alias("var1"), F.get(names[1], F.col("pair")).alias("var2"), "a", "b", "n")


def cramers_v(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cramer's V (uncorrected) of every pair of categorical columns."""
    pairs = materialize(pair_counts(df, cols), "joint-counts")
    both = ["var1", "var2"]
    ma = pairs.groupBy(*both, "a").agg(F.sum("n").alias("ma"))
    mb = pairs.groupBy(*both, "b").agg(F.sum("n").alias("mb"))
    rows = ma.groupBy(*both).agg(F.count("*").alias("r"))
    columns = mb.groupBy(*both).agg(F.count("*").alias("c"))
    n = F.col("n").cast("double")
    share = pairs.join(ma, [*both, "a"]).join(mb, [*both, "b"]).groupBy(*both).agg(F.sum(n * n / (F.col("ma").cast("double") * F.col("mb"))).alias("s"))
    smaller = F.least("r", "c")
    v = F.when(smaller > 1, F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / (smaller - 1)))
    return share.join(rows, both).join(columns, both).select(*both, v.alias("v"))
