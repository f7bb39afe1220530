"""Shared pieces of the query catalog: base frames and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.stats import HART_DEN, HART_LIMIT, HART_NUM, SQRT_TWO_PI
from tallyward.plans import encounter_rules as R
from tallyward.plans.mart import build_mart, cohort, derive_features, stage
from tallyward.sources.fixtures import ENCOUNTERS_SQL, encounters

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Queries with the SQL they are checked against, where SQL can say it."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = query
        if sql is not None:
            self.oracles[name] = sql

    def query(self, name: str, sql: str | None = None):
        def register(fn: Query) -> Query:
            self.add(name, fn, sql)
            return fn

        return register


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Listed columns rounded to six decimals, the catalog's last projection."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


# --- Spark side -------------------------------------------------------------

MEDS = R.MEDICATIONS


def raw(spark: SparkSession, d: str) -> DataFrame:
    return encounters(spark, d)


def staged(spark: SparkSession, d: str) -> DataFrame:
    return stage(raw(spark, d), ["prob"])


def features(spark: SparkSession, d: str) -> DataFrame:
    return derive_features(cohort(staged(spark, d)), ["prob"])


def mart(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The mart as a stored table: several passes read it, each its own columns.

    With ``columns`` only those (and the key and split) are built.
    """
    return build_mart(raw(spark, d), ["prob"], materialized=True, columns=columns or None)


def any_of(col: Column, *values) -> Column:
    return col.isin(*values)


# --- SQL side ---------------------------------------------------------------


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def sql_case_in(col: str, groups: dict) -> str:
    arms = " ".join(f"WHEN {col} IN ({sql_list(m)}) THEN '{g}'" for g, m in groups.items())
    return f"CASE {arms} END"


def sql_diagnosis(col: str, null_label: str | None = None) -> str:
    number = f"(CASE WHEN regexp_matches({col}, '^[0-9]+([.][0-9]*)?$') THEN TRY_CAST({col} AS DOUBLE) END)"
    arms = [f"WHEN {col} IS NULL THEN '{null_label}'"] if null_label else []
    arms += [f"WHEN starts_with({col}, '{p}') THEN '{label}'" for p, label in R.DIAGNOSIS_PREFIXES.items()]
    for label, low, high, extra in R.DIAGNOSIS_RANGES:
        more = f" OR {col} = '{extra}'" if extra else ""
        arms.append(f"WHEN {number} BETWEEN {low} AND {high}{more} THEN '{label}'")
    return f"CASE {' '.join(arms)} ELSE '{R.DIAGNOSIS_DEFAULT}' END"


def sql_pattern(col: str, rules, null_label: str, default: str) -> str:
    words = {"ilike": "ILIKE", "eq": "="}
    arms = [f"WHEN {col} {words[kind]} '{value}' THEN '{label}'" for kind, value, label in rules]
    return f"CASE {' '.join(arms)} ELSE IF({col} IS NULL, '{null_label}', '{default}') END"


def sql_sum(terms) -> str:
    return " + ".join(terms)


def sql_normal_upper(x: str) -> str:
    """Hart's tail in SQL, term by term as in the column expression."""

    def horner(coefs):
        acc = repr(coefs[0])
        for c in coefs[1:]:
            acc = f"({acc} * ABS({x}) + {c!r})"
        return acc

    near = f"EXP(-ABS({x}) * ABS({x}) / 2) * {horner(HART_NUM)} / {horner(HART_DEN)}"
    frac = f"(ABS({x}) + 0.65)"
    for k in (4.0, 3.0, 2.0, 1.0):
        frac = f"(ABS({x}) + {k} / {frac})"
    far = f"EXP(-ABS({x}) * ABS({x}) / 2) / {frac} / {SQRT_TWO_PI}"
    tail = f"(CASE WHEN ABS({x}) > 37 THEN 0.0 WHEN ABS({x}) < {HART_LIMIT} THEN {near} ELSE {far} END)"
    return f"(CASE WHEN {x} > 0 THEN {tail} ELSE 1 - {tail} END)"


SQL_SPECIALTY = sql_pattern("medical_specialty", R.SPECIALTY_RULES, R.SPECIALTY_NULL, R.SPECIALTY_DEFAULT)
SQL_AGE_MIDPOINT = f"MAP({list(R.AGE_MIDPOINTS)}, {list(R.AGE_MIDPOINTS.values())})[age]"
SQL_CHANGED = sql_sum(f"CAST({m} IN ('Up', 'Down') AS INTEGER)" for m in MEDS)
SQL_ACTIVE = sql_sum(f"CAST({m} <> 'No' AS INTEGER)" for m in MEDS)
PRIOR = ["number_outpatient", "number_emergency", "number_inpatient"]

_sentinels = ", ".join(f"IF({c} IN ({sql_list(marks)}), NULL, {c}) AS {c}" for c, marks in R.SENTINELS.items())
SQL_STAGED = f"""SELECT * EXCLUDE (diabetesmed, readmitted) REPLACE ({_sentinels}),
  diabetesmed AS diabetes_med, readmitted AS readmitted_raw,
  COALESCE(CAST(readmitted = '{R.POSITIVE_OUTCOME}' AS INTEGER), 0) AS readmitted_30day,
  COALESCE(CAST(readmitted <> '{R.NEGATIVE_OUTCOME}' AS INTEGER), 1) AS readmitted_any
FROM enc"""

SQL_DEDUPED = f"""SELECT UNNEST(best) FROM (
  SELECT ARG_MAX(staged, ROW(time_in_hospital, {R.KEY})) AS best FROM staged GROUP BY {R.ENTITY})"""

SQL_FILTERED = "SELECT * FROM deduped WHERE " + " AND ".join(
    [f"NOT list_contains({codes}, {c})" for c, codes in R.EXCLUDED_CODES.items()]
    + [f"{c} IS NOT NULL" for c in R.REQUIRED_COLUMNS]
)

_derived = {
    "age_midpoint": SQL_AGE_MIDPOINT,
    "age_group": sql_case_in("age", R.AGE_GROUPS),
    "admission_type_group": sql_case_in("admission_type_id", R.ADMISSION_GROUPS),
    "total_prior_encounters": sql_sum(PRIOR),
    "specialty_group": SQL_SPECIALTY,
    "diag_1_group": sql_diagnosis("diag_1"),
    **{f"{c}_group": sql_diagnosis(c, R.DIAGNOSIS_NONE) for c in ("diag_2", "diag_3")},
    "num_med_changes": SQL_CHANGED,
    "num_meds_active": SQL_ACTIVE,
}
SQL_FEATURES = (
    f"SELECT * EXCLUDE (age, weight, payer_code, {', '.join(R.DROPPED_MEDICATIONS)}) "
    f"REPLACE (COALESCE(race, '{R.RACE_DEFAULT}') AS race), age AS age_band, "
    + ", ".join(f"{q} AS {c}" for c, q in _derived.items())
    + " FROM filtered"
)

_limits = " ".join(f"WHEN pr < {limit} THEN '{name}'" for name, limit in R.SPLIT_LIMITS)
SQL_MART = (
    f"SELECT *, CASE {_limits} ELSE '{R.SPLIT_LAST}' END AS {R.SPLIT} FROM (SELECT *, "
    f"(ROW_NUMBER() OVER (ORDER BY {R.KEY}) - 1) / GREATEST(COUNT(*) OVER () - 1, 1) AS pr FROM features)"
)

_STEPS = [
    ("enc", ENCOUNTERS_SQL.strip()),
    ("staged", SQL_STAGED),
    ("deduped", SQL_DEDUPED),
    ("filtered", SQL_FILTERED),
    ("features", SQL_FEATURES),
    ("mart", SQL_MART),
]


def with_steps(last: str, body: str, **more: str) -> str:
    """SQL text with the base steps up to ``last``, extra steps, then the body."""
    names = [n for n, _ in _STEPS]
    steps = _STEPS[: names.index(last) + 1] + list(more.items())
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in steps) + "\n" + body
