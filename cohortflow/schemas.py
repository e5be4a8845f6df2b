"""Data contracts.

Raw tables are read with every column as string; the record stage casts late
through ``try_cast`` and reports rows that fail.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values of the data contract (must equal the original's) ---------
# Raw input tables and the columns the engine reads from each.
RAW_COLUMNS: dict[str, list[str]] = {
    "admissions": ["SUBJECT_ID", "HADM_ID", "ADMITTIME"],
    "diagnoses": ["SUBJECT_ID", "HADM_ID", "ICD9_CODE"],
    "icustays": ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "LOS"],
    "labevents": ["SUBJECT_ID", "HADM_ID", "ITEMID", "VALUENUM"],
    "patients": ["SUBJECT_ID", "DOD_HOSP"],
    "prescriptions": ["SUBJECT_ID", "HADM_ID", "DRUG"],
}

# Default raw file name per table.
RAW_FILES: dict[str, str] = {
    "admissions": "ADMISSIONS.csv",
    "diagnoses": "DIAGNOSES_ICD.csv",
    "icustays": "ICUSTAYS.csv",
    "labevents": "LABEVENTS.csv",
    "patients": "PATIENTS.csv",
    "prescriptions": "PRESCRIPTIONS.csv",
}

# Columns of the prepared (split) tables.
PREPARED_COLUMNS: dict[str, list[str]] = {
    "admissions": ["SUBJECT_ID", "HADM_ID", "ADMITTIME"],
    "diagnoses": ["SUBJECT_ID", "HADM_ID", "ICD9_CODE"],
    "icustays": ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "LOS"],
    "labevents": ["SUBJECT_ID", "HADM_ID", "ITEMID", "VALUENUM"],
    "patients": ["SUBJECT_ID", "IS_DEAD"],
    "prescriptions": ["SUBJECT_ID", "HADM_ID", "DRUG"],
}

# File stem of each prepared table in the split folders.
SPLIT_FILES: dict[str, str] = {
    "admissions": "admissions",
    "diagnoses": "diagnoses",
    "icustays": "icustays",
    "labevents": "labevents",
    "patients": "patients",
    "prescriptions": "prescripts",
}

SPLITS = ("train", "test", "valid")
DEFAULT_WEIGHTS = (65.0, 20.0, 15.0)
DEFAULT_SEED = 1

# Domains of the vocabulary, in overwrite order (a later domain wins a token).
DOMAINS = ("diagnosis", "medication", "lab", "icu")
# ---------------------------------------------------------------------------


FEATURES_SCHEMA = T.StructType(
    [
        T.StructField("patientID", T.LongType(), True),
        T.StructField("admitTime", T.LongType(), True),
        T.StructField("featureID", T.LongType(), True),
        T.StructField("featureValue", T.DoubleType(), True),
    ]
)

LABELS_SCHEMA = T.StructType(
    [
        T.StructField("patientID", T.LongType(), True),
        T.StructField("IS_DEAD", T.IntegerType(), True),
    ]
)

PAIR = T.StructType(
    [T.StructField("feature_id", T.LongType(), True), T.StructField("value", T.DoubleType(), True)]
)
