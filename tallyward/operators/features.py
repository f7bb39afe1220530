"""Feature matrix fitted on the training split only.

Fitting needs one aggregate for the numeric columns and one distinct pass for
the categories. The fitted plan becomes native ML stages (a SQL projection
and a vector assembler), so it saves, loads and streams like any Spark model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.cohort import present_columns
from tallyward.operators.profile import to_long

MAX_LEVELS = 10_000


def category_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct non-NULL values per column.

    A one-hot matrix must be narrow, so more than ``max_levels`` values in all
    is an error, not a truncation.
    """
    pairs = to_long(df, [], cols, "string").select("variable", "value").distinct()
    rows = pairs.limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} category levels in {list(cols)}")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        levels[r["variable"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def sql_text(value: str) -> str:
    """Quoted SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class FeaturePlan:
    """Fitted encoders: everything needed to turn rows into the matrix."""

    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    ordinals: list[tuple[str, str, tuple[str, ...]]] = field(default_factory=list)
    levels: dict[str, list[str]] = field(default_factory=dict)

    def names(self) -> list[str]:
        """Feature names in matrix order: numeric, ordinal, one-hot."""
        out = [f"numeric__{c}" for c in self.scale]
        out += [f"{group}__{c}" for group, c, _ in self.ordinals]
        out += [f"nominal__{c}_{v}" for c, values in self.levels.items() for v in values[1:]]
        return out

    def expressions(self) -> dict[str, str]:
        """SQL expression per feature name."""
        out = {}
        for c, (mean, sd) in self.scale.items():
            out[f"numeric__{c}"] = f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {sd!r}D"
        for group, c, order in self.ordinals:
            arms = " ".join(f"WHEN {sql_text(v)} THEN {i}.0D" for i, v in enumerate(order))
            out[f"{group}__{c}"] = f"CASE `{c}` {arms} ELSE -1.0D END"
        for c, values in self.levels.items():
            for v in values[1:]:
                out[f"nominal__{c}_{v}"] = f"IF(CAST(`{c}` AS STRING) <=> {sql_text(v)}, 1.0D, 0.0D)"
        return out

    def columns(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Matrix as named double columns next to the kept ones."""
        return df.select(*keep, *[F.expr(e).alias(n) for n, e in self.expressions().items()])

    def stages(self, output: str = "features") -> list:
        """Native ML stages: add the feature columns, assemble, drop the columns again."""
        exprs = self.expressions()
        select = ", ".join(f"{e} AS `{n}`" for n, e in exprs.items())
        names = ", ".join(f"`{n}`" for n in exprs)
        return [
            SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
            VectorAssembler(inputCols=list(exprs), outputCol=output, handleInvalid="keep"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({names}) FROM __THIS__"),
        ]

    def model(self, df: DataFrame, output: str = "features") -> PipelineModel:
        return Pipeline(stages=self.stages(output)).fit(df)

    def manifest(self, df: DataFrame) -> DataFrame:
        """Feature names with their position."""
        rows = list(enumerate(self.names()))
        return df.sparkSession.createDataFrame(rows, "position int, feature string")


def fit_features(
    train: DataFrame,
    numeric: Sequence[str],
    ordinal: Sequence[tuple[str, str, Sequence[str]]],
    nominal: Sequence[str],
    strict: bool = False,
) -> FeaturePlan:
    """Fit on the training rows; columns that do not exist are skipped unless ``strict``.

    Numeric columns get mean and population sd (a constant column keeps sd 1),
    ordinals ``(group, column, order)`` their declared codes with -1 for
    anything else, nominals one column per training level but the first.
    """
    numeric = present_columns(train, numeric, strict)
    nominal = present_columns(train, nominal, strict)
    known = set(present_columns(train, [c for _, c, _ in ordinal], strict))
    scale: dict[str, tuple[float, float]] = {}
    if numeric:
        row = train.agg(
            *[
                F.struct(
                    F.avg(c).alias("m"),
                    # a constant column: its computed deviation may be rounding noise
                    F.when(F.min(c) < F.max(c), F.stddev_pop(c)).alias("s"),
                ).alias(c)
                for c in numeric
            ]
        ).first()
        scale = {c: (float(row[c]["m"] or 0.0), float(row[c]["s"] or 1.0)) for c in numeric}
    return FeaturePlan(
        scale=scale,
        ordinals=[(g, c, tuple(o)) for g, c, o in ordinal if c in known],
        levels=category_levels(train, nominal) if nominal else {},
    )


def ordinal_columns(meds: Sequence[str], med_order, a1c_order, glucose_order) -> list[tuple[str, str, Sequence[str]]]:
    """Declared ordinals of the encounter domain, in matrix order."""
    return [
        *[("med_ord", m, med_order) for m in meds],
        ("a1c_ord", "a1cresult", a1c_order),
        ("glu_ord", "max_glu_serum", glucose_order),
    ]


def safe_names(names: Sequence[str], table: Mapping[int, str] | None = None) -> list[str]:
    """Names without the characters some model libraries refuse."""
    table = table or str.maketrans({"[": "(", "]": ")", "<": "lt"})
    return [n.translate(table) for n in names]
