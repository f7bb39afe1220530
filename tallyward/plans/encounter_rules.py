"""Rules of the hospital-encounter domain.

Fixed values: code lists, labels and column names the results depend on. The
operators never refer to them; another domain supplies another module.
"""

KEY = "encounter_id"
ENTITY = "patient_nbr"
LABEL = "readmitted_30day"
SPLIT = "split_group"

ID_COLUMNS = ["encounter_id", "patient_nbr"]
COUNT_COLUMNS = [
    "admission_type_id",
    "discharge_disposition_id",
    "admission_source_id",
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
]
# '?' stands for missing; 'None' in the lab columns means "not tested" and stays
SENTINELS = {
    "race": ["?"],
    "gender": ["Unknown/Invalid"],
    "weight": ["?"],
    "payer_code": ["?"],
    "medical_specialty": ["?"],
    "diag_1": ["?"],
    "diag_2": ["?"],
    "diag_3": ["?"],
}
LAB_COLUMNS = ["max_glu_serum", "a1cresult"]

RAW_MEDICATIONS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide_metformin",
    "glipizide_metformin", "glimepiride_pioglitazone",
    "metformin_rosiglitazone", "metformin_pioglitazone",
]
# constant or nearly constant columns that never reach the mart
DROPPED_MEDICATIONS = ["examide", "citoglipton", "troglitazone", "acetohexamide"]
MEDICATIONS = [m for m in RAW_MEDICATIONS if m not in DROPPED_MEDICATIONS]
# near-zero variance, left out of the model features
UNMODELLED_MEDICATIONS = [
    "glimepiride_pioglitazone", "metformin_pioglitazone",
    "metformin_rosiglitazone", "glipizide_metformin", "tolbutamide",
    "miglitol", "tolazamide", "chlorpropamide", "acarbose",
    "glyburide_metformin", "nateglinide",
]
MODELLED_MEDICATIONS = [
    "metformin", "repaglinide", "glimepiride", "glipizide", "glyburide",
    "pioglitazone", "rosiglitazone", "insulin",
]

POSITIVE_OUTCOME = "<30"
NEGATIVE_OUTCOME = "NO"

EXCLUDED_CODES = {
    "discharge_disposition_id": [10, 11, 12, 13, 14, 19, 20, 21],
    "admission_source_id": [11, 12, 13, 14, 23, 24],
}
REQUIRED_COLUMNS = ["diag_1", "gender"]

RACE_DEFAULT = "Caucasian"
AGE_BANDS = [f"[{low}-{low + 10})" for low in range(0, 100, 10)]
AGE_MIDPOINTS = {band: 10 * i + 5 for i, band in enumerate(AGE_BANDS)}
AGE_GROUPS = {"young": AGE_BANDS[:3], "middle": AGE_BANDS[3:6], "senior": AGE_BANDS[6:]}
ADMISSION_GROUPS = {
    "Emergency": [1, 2, 7],
    "Elective": [3],
    "Newborn": [4],
    "Unknown": [5, 6, 8],
}
SPECIALTY_RULES = [
    ("ilike", "%surgery%", "Surgery"),
    ("ilike", "%internal%", "Internal Medicine"),
    ("eq", "Cardiology", "Cardiology"),
    ("ilike", "%emergency%", "Emergency"),
]
SPECIALTY_NULL = "Unknown"
SPECIALTY_DEFAULT = "Other"

DIAGNOSIS_PREFIXES = {"250": "Diabetes"}
DIAGNOSIS_RANGES = [
    ("Circulatory", 390, 459, "785"),
    ("Respiratory", 460, 519, "786"),
    ("Digestive", 520, 579, "787"),
    ("Genitourinary", 580, 629, "788"),
    ("Injury", 800, 999, None),
    ("Musculoskeletal", 710, 739, None),
    ("Neoplasms", 140, 239, None),
]
DIAGNOSIS_DEFAULT = "Other"
DIAGNOSIS_NONE = "None"
DIAGNOSIS_GROUPS = [
    "Diabetes", "Circulatory", "Respiratory", "Digestive", "Genitourinary",
    "Injury", "Musculoskeletal", "Neoplasms", "Other",
]

SPLIT_LIMITS = [("train", 0.70), ("validation", 0.80)]
SPLIT_LAST = "holdout"
SPLIT_ORDER = ["train", "validation", "holdout"]

NUMERIC_FEATURES = [
    "age_midpoint", "time_in_hospital", "num_lab_procedures",
    "num_procedures", "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient", "number_diagnoses",
    "total_prior_encounters", "num_med_changes", "num_meds_active",
]
NOMINAL_FEATURES = [
    "race", "gender", "age_band", "age_group", "admission_type_group",
    "specialty_group", "diag_1_group", "diag_2_group", "diag_3_group",
    "change", "diabetes_med",
]
MEDICATION_ORDER = ["No", "Steady", "Down", "Up"]
A1C_ORDER = ["None", "Norm", ">7", ">8"]
GLUCOSE_ORDER = ["None", "Norm", ">200", ">300"]

# features and levels the monitoring reports use
DRIFT_FEATURES = [
    "number_inpatient", "num_medications", "time_in_hospital",
    "number_diagnoses", "num_lab_procedures", "number_emergency",
    "age_midpoint",
]
TRAINING_TAU = 0.10
DEPLOYED_TAU = 0.12
