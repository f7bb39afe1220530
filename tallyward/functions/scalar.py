"""Row-level expressions: clean-up, grouping rules, row-wise counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if(col: str | Column, *sentinels: str) -> Column:
    """NULL where the value equals one of the sentinels."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~c.isin(*sentinels), c)


def flag(pred: Column) -> Column:
    """0/1 of a predicate; an unknown predicate counts as 0."""
    return F.coalesce(pred.cast("int"), F.lit(0))


def value_map(col: str, mapping: Mapping) -> Column:
    """Value of ``mapping`` for each entry, NULL for values it does not list."""
    c = F.col(col)
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


def group_map(col: str, groups: Mapping[str, Sequence]) -> Column:
    """Name of the first group whose members contain the value, else NULL."""
    c = F.col(col)
    out = None
    for name, members in groups.items():
        cond = c.isin(*members)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def pattern_group(col: str, rules: Sequence[tuple[str, str, str]], null_label: str, default: str) -> Column:
    """First matching rule wins.

    A rule is ``(kind, text, label)``; kind ``ilike`` tests a pattern without
    regard to case, kind ``eq`` the exact value.
    """
    c = F.col(col)
    out = None
    for kind, text, label in rules:
        cond = c.ilike(text) if kind == "ilike" else c == text
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.when(c.isNull(), null_label).otherwise(default)


def code_group(
    col: str,
    prefix_rules: Mapping[str, str],
    ranges: Sequence[tuple[str, float, float, str | None]],
    default: str,
    null_label: str | None = None,
) -> Column:
    """Group of a diagnosis-like code.

    ``prefix_rules`` maps a code prefix to a label, ``ranges`` holds
    ``(label, low, high, extra code)`` with inclusive bounds on the decimal
    value. Only plain decimals are read as numbers: Spark's cast also accepts
    ``459d`` and ``1e2``, which are not codes.
    """
    c = F.col(col)
    number = F.when(c.rlike(r"^[0-9]+([.][0-9]*)?$"), c.try_cast("double"))
    out = F.when(c.isNull(), null_label) if null_label is not None else None
    for prefix, label in prefix_rules.items():
        cond = c.startswith(prefix)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    for label, low, high, extra in ranges:
        cond = number.between(low, high)
        if extra is not None:
            cond = cond | (c == extra)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def row_sum(cols: Sequence[str]) -> Column:
    return reduce(add, [F.col(c) for c in cols])


def count_in(cols: Sequence[str], values: Sequence[str]) -> Column:
    """How many of the columns hold one of the values; NULL counts 0."""
    return reduce(add, [F.when(F.col(c).isin(*values), 1).otherwise(0) for c in cols])


def count_not(cols: Sequence[str], value: str) -> Column:
    """How many of the columns differ from the value; NULL counts 0."""
    return reduce(add, [F.when(F.col(c) != value, 1).otherwise(0) for c in cols])


def ordinal(col: str, order: Sequence[str], unknown: int | None = None) -> Column:
    """Zero-based position in the declared order; ``unknown`` for anything else."""
    c = F.col(col)
    out = None
    for i, value in enumerate(order):
        out = F.when(c == value, i) if out is None else out.when(c == value, i)
    return out if unknown is None else out.otherwise(unknown)


def exclude(codes: Mapping[str, Sequence[int]], required: Sequence[str]) -> Column:
    """Predicate: no code column holds a listed code, no required column is NULL.

    A NULL code makes the predicate unknown, so ``where`` drops the row.
    """
    parts = [~F.col(c).isin(*vals) for c, vals in codes.items()]
    parts += [F.col(c).isNotNull() for c in required]
    return reduce(lambda a, b: a & b, parts)


def near_any(col: str, values: Sequence[float], eps: float) -> Column:
    """True where the column lies within ``eps`` of one of the values."""
    return reduce(lambda a, b: a | b, [F.abs(F.col(col) - F.lit(v)) < eps for v in values])


def tidy_name(col: Column, prefixes: Sequence[str] = ()) -> Column:
    """Readable label: known prefixes removed, ``_`` to space, title case."""
    if prefixes:
        col = F.regexp_replace(col, "^(" + "|".join(prefixes) + ")", "")
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def safe_name(col: Column) -> Column:
    """Feature name without the characters model libraries refuse."""
    return F.replace(F.translate(col, "[]", "()"), F.lit("<"), F.lit("lt"))


def r6(col: Column) -> Column:
    """Report rounding: six decimals."""
    return F.round(col, 6)
