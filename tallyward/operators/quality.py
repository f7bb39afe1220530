"""Declarative data-quality rules, checked in one pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; NULLs are ignored."""

    column: str


@dataclass(frozen=True)
class Accepted:
    """Every value is listed; NULL passes."""

    column: str
    values: tuple


Rule = NotNull | Unique | Accepted
RULE_NAMES = {NotNull: "not_null", Unique: "unique", Accepted: "accepted_values"}


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report rows ``(rule, column, failures, status)``, one per rule.

    All row-level rules share one aggregate over a pruned scan. A uniqueness
    rule counts repeated values with map-side combine; its failures are the
    number of distinct values that repeat.
    """
    by_row = [r for r in rules if not isinstance(r, Unique)]
    reports = []
    if by_row:
        counts = []
        for r in by_row:
            c = F.col(r.column)
            bad = c.isNull() if isinstance(r, NotNull) else ~c.isin(*r.values)
            counts.append(F.count_if(bad))
        one = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(RULE_NAMES[type(r)]).alias("rule"),
                        F.lit(r.column).alias("column"),
                        n.alias("failures"),
                    )
                    for r, n in zip(by_row, counts)
                ]
            ).alias("rows")
        )
        reports.append(one.select(F.inline("rows")))
    for r in rules:
        if isinstance(r, Unique):
            repeated = df.where(F.col(r.column).isNotNull()).groupBy(r.column).count().where("count > 1")
            reports.append(
                repeated.agg(F.count("*").alias("failures")).select(
                    F.lit("unique").alias("rule"), F.lit(r.column).alias("column"), "failures"
                )
            )
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
