"""Raw encounters to staging to the one-row-per-patient feature mart.

The whole chain is one lazy plan. Its only row shuffle is the de-duplication;
the temporal split adds column-pruned scans but moves no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.scalar import (
    code_group,
    count_in,
    count_not,
    group_map,
    null_if,
    pattern_group,
    row_sum,
    value_map,
)
from tallyward.operators.cohort import apply_exclusions, keep_preferred, present_columns
from tallyward.operators.ordered import fraction_split
from tallyward.operators.quality import Accepted, NotNull, Unique
from tallyward.plans import encounter_rules as R
from tallyward.session import materialize


def stage(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Typed columns, sentinels to NULL, the two binary outcomes.

    A NULL outcome gives 0 for the 30-day flag and 1 for the any-time flag.
    ``extra`` columns pass through unchanged.
    """
    meds = present_columns(raw, R.RAW_MEDICATIONS)
    select = [F.col(c).try_cast("long").alias(c) for c in R.ID_COLUMNS]
    select += [null_if(c, *R.SENTINELS[c]).alias(c) for c in ("race", "gender")]
    select += [F.col("age"), null_if("weight", *R.SENTINELS["weight"]).alias("weight")]
    select += [F.col(c).try_cast("int").alias(c) for c in R.COUNT_COLUMNS]
    select += [
        null_if(c, *R.SENTINELS[c]).alias(c)
        for c in ("payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3")
    ]
    outcome = F.col("readmitted")
    select += [
        *[F.col(c) for c in R.LAB_COLUMNS + meds + ["change"]],
        F.col("diabetesmed").alias("diabetes_med"),
        outcome.alias("readmitted_raw"),
        F.when(outcome == R.POSITIVE_OUTCOME, 1).otherwise(0).alias("readmitted_30day"),
        F.when(outcome == R.NEGATIVE_OUTCOME, 0).otherwise(1).alias("readmitted_any"),
        *[F.col(c) for c in extra or []],
    ]
    return raw.select(*select)


def deduplicate(staged: DataFrame) -> DataFrame:
    """Longest stay per patient, the latest encounter on ties."""
    return keep_preferred(staged, [R.ENTITY], [F.desc("time_in_hospital"), F.desc(R.KEY)])


def cohort(staged: DataFrame) -> DataFrame:
    """Exclusions after de-duplication: a patient whose preferred encounter is
    excluded leaves the cohort altogether."""
    return apply_exclusions(deduplicate(staged), R.EXCLUDED_CODES, R.REQUIRED_COLUMNS)


def diagnosis_group(col: str, null_label: str | None = None):
    return code_group(col, R.DIAGNOSIS_PREFIXES, R.DIAGNOSIS_RANGES, R.DIAGNOSIS_DEFAULT, null_label)


def specialty_group(col: str = "medical_specialty"):
    return pattern_group(col, R.SPECIALTY_RULES, R.SPECIALTY_NULL, R.SPECIALTY_DEFAULT)


def derive_features(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Grouped and counted columns of the mart, keys carried along."""
    meds = present_columns(df, R.MEDICATIONS)
    return df.select(
        R.KEY,
        R.ENTITY,
        "readmitted_raw",
        "readmitted_30day",
        "readmitted_any",
        F.coalesce("race", F.lit(R.RACE_DEFAULT)).alias("race"),
        "gender",
        F.col("age").alias("age_band"),
        value_map("age", R.AGE_MIDPOINTS).alias("age_midpoint"),
        group_map("age", R.AGE_GROUPS).alias("age_group"),
        "admission_type_id",
        "discharge_disposition_id",
        "admission_source_id",
        group_map("admission_type_id", R.ADMISSION_GROUPS).alias("admission_type_group"),
        "time_in_hospital",
        "num_lab_procedures",
        "num_procedures",
        "num_medications",
        "number_diagnoses",
        "number_outpatient",
        "number_emergency",
        "number_inpatient",
        row_sum(["number_outpatient", "number_emergency", "number_inpatient"]).alias("total_prior_encounters"),
        "medical_specialty",
        specialty_group().alias("specialty_group"),
        "diag_1",
        "diag_2",
        "diag_3",
        diagnosis_group("diag_1").alias("diag_1_group"),
        diagnosis_group("diag_2", R.DIAGNOSIS_NONE).alias("diag_2_group"),
        diagnosis_group("diag_3", R.DIAGNOSIS_NONE).alias("diag_3_group"),
        *R.LAB_COLUMNS,
        *meds,
        "change",
        "diabetes_med",
        count_in(meds, ["Up", "Down"]).alias("num_med_changes"),
        count_not(meds, "No").alias("num_meds_active"),
        *[F.col(c) for c in extra or []],
    )


def assign_split(df: DataFrame) -> DataFrame:
    """Temporal split: the ascending encounter id stands for time."""
    return fraction_split(df, R.KEY, R.SPLIT_LIMITS, R.SPLIT_LAST, R.SPLIT)


def build_mart(
    raw: DataFrame,
    extra: list[str] | None = None,
    materialized: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Raw rows to the feature mart.

    With ``materialized`` the features are written once to the shared folder
    before the split, so that at scale the de-duplication shuffle runs once
    and the split's passes are scans of one column. ``columns`` keeps a mart
    for one purpose narrow: what it leaves out is never shuffled or written.
    """
    features = derive_features(cohort(stage(raw, extra)), extra)
    if columns is not None:
        features = features.select(R.KEY, *[c for c in columns if c != R.KEY])
    if materialized:
        features = materialize(features, "mart")
    return assign_split(features)


STAGING_RULES = [
    NotNull("encounter_id"),
    Unique("encounter_id"),
    NotNull("patient_nbr"),
    NotNull("readmitted_30day"),
    Accepted("readmitted_30day", (0, 1)),
    NotNull("readmitted_any"),
    Accepted("readmitted_any", (0, 1)),
]

MART_RULES = [
    NotNull("readmitted_30day"),
    Accepted("readmitted_30day", (0, 1)),
    NotNull("split_group"),
    Accepted("split_group", tuple(R.SPLIT_ORDER)),
    NotNull("age_midpoint"),
    NotNull("race"),
    NotNull("gender"),
    NotNull("total_prior_encounters"),
    NotNull("num_med_changes"),
    NotNull("num_meds_active"),
    NotNull("diag_1_group"),
    Accepted("diag_1_group", tuple(R.DIAGNOSIS_GROUPS)),
    NotNull("diag_2_group"),
    Accepted("diag_2_group", (*R.DIAGNOSIS_GROUPS, R.DIAGNOSIS_NONE)),
    NotNull("diag_3_group"),
    Accepted("diag_3_group", (*R.DIAGNOSIS_GROUPS, R.DIAGNOSIS_NONE)),
    NotNull("admission_type_group"),
    Accepted("admission_type_group", tuple(R.ADMISSION_GROUPS)),
]
