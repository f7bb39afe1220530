"""Cohort building: one row per entity, exclusions, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.scalar import exclude


def keep_preferred(df: DataFrame, keys: Sequence[str], preference: Sequence[Column]) -> DataFrame:
    """First row per key in the given preference.

    ``row_number() = 1`` lets Catalyst add a group limit before the shuffle,
    so every map task sends at most one row per key and a hot key costs no
    more than a rare one.
    """
    order = Window.partitionBy(*keys).orderBy(*preference)
    return df.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def apply_exclusions(df: DataFrame, codes: Mapping[str, Sequence[int]], required: Sequence[str]) -> DataFrame:
    """Rows that hold none of the excluded codes and all required values."""
    return df.where(exclude(codes, required))


def split_summary(df: DataFrame, split: str, label: str, order: Sequence[str]) -> DataFrame:
    """Rows, positives and rate per split, in the declared order."""
    position = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(split))
    return (
        df.groupBy(split)
        .agg(
            F.count("*").alias("n"),
            F.sum(label).cast("long").alias("n_positive"),
            F.avg(label).alias("positive_rate"),
        )
        .orderBy(position)
    )


def present_columns(df: DataFrame, wanted: Sequence[str], strict: bool = False) -> list[str]:
    """Wanted columns that exist, in the wanted order; ``strict`` rejects gaps."""
    have = set(df.columns)
    if strict and (gaps := [c for c in wanted if c not in have]):
        raise ValueError(f"missing columns: {gaps}")
    return [c for c in wanted if c in have]


def as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})
