"""Cleaning and record contracts.

A record contract says which columns must be present and how each typed
field is derived.  ``validate`` adds a ``reject_reason`` (NULL for good rows)
in one projection; ``to_records`` keeps the good rows and ``rejects`` the bad
ones, so a dirty value never aborts a job.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.cast import admit_day_millis, derive_label, to_double, to_int, to_long
from cohortflow.functions.text import icd9_category, jvm_trim


#: Of raw rows not yet joined to the cohort, see ``with_odd_id``.
ODD_ID = "odd_id"


@dataclass(frozen=True)
class Contract:
    required: list[str]
    # (output name, builder from the input columns); a NULL result of a
    # present input is a "bad <source>" reject.
    fields: list[tuple[str, str, object]] = field(default_factory=list)


def _same(c: str) -> Column:
    return F.col(c).cast("string")


# Typed record per table: output field, source column, conversion.
CONTRACTS: dict[str, Contract] = {
    "patients": Contract(
        ["SUBJECT_ID", "IS_DEAD"],
        [("patient_id", "SUBJECT_ID", to_long), ("is_dead", "IS_DEAD", to_int)],
    ),
    "labevents": Contract(
        ["SUBJECT_ID", "HADM_ID", "ITEMID", "VALUENUM"],
        [
            ("patient_id", "SUBJECT_ID", to_long),
            ("hadm_id", "HADM_ID", _same),
            ("item", "ITEMID", _same),
            ("value", "VALUENUM", to_double),
        ],
    ),
    "diagnoses": Contract(
        ["SUBJECT_ID", "HADM_ID", "ICD9_CODE"],
        [
            ("patient_id", "SUBJECT_ID", to_long),
            ("hadm_id", "HADM_ID", _same),
            ("code", "ICD9_CODE", _same),
            # A blank code has no category: reject instead of failing.
            ("_category", "ICD9_CODE", icd9_category),
        ],
    ),
    "prescriptions": Contract(
        ["SUBJECT_ID", "HADM_ID", "DRUG"],
        [("patient_id", "SUBJECT_ID", to_long), ("hadm_id", "HADM_ID", _same), ("drug", "DRUG", _same)],
    ),
    "admissions": Contract(
        ["SUBJECT_ID", "HADM_ID", "ADMITTIME"],
        [
            ("patient_id", "SUBJECT_ID", to_long),
            ("hadm_id", "HADM_ID", _same),
            ("admit_ms", "ADMITTIME", admit_day_millis),
        ],
    ),
    "icustays": Contract(
        ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "LOS"],
        [
            ("patient_id", "SUBJECT_ID", to_long),
            ("hadm_id", "HADM_ID", _same),
            ("icustay_id", "ICUSTAY_ID", _same),
            ("los", "LOS", to_double),
        ],
    ),
}


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def present(df: DataFrame, c: str) -> Column:
    """P5 for one column: NOT NULL, and for text also not ''."""
    cond = F.col(c).isNotNull()
    if _is_string(df, c):
        cond = cond & (F.col(c) != F.lit(""))
    return cond


def require(df: DataFrame, *cols: str) -> DataFrame:
    """P5: keep rows where every listed column is present."""
    return df.filter(reduce(lambda a, b: a & b, [present(df, c) for c in cols]))


def validate(df: DataFrame, table: str, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """Typed fields plus ``reject_reason`` (first failing check, NULL if none)."""
    contract = CONTRACTS[table]
    checks = [F.when(~present(df, c), F.lit(f"missing {c}")) for c in contract.required]
    typed = []
    for name, src, conv in contract.fields:
        value = conv(src)
        typed.append(value.alias(name))
        checks.append(F.when(F.col(src).isNotNull() & value.isNull(), F.lit(f"bad {src}")))
    keep = [c for c in ("split",) if c in df.columns]
    # Raw keys kept for the reject report (names differ from the typed ones:
    # Spark resolves column names case-insensitively).
    raw = [F.col(c).cast("string").alias(f"raw_{c.lower()}") for c in ("SUBJECT_ID", "HADM_ID") if c in df.columns]
    return df.select(*keep, *keep_columns, *raw, *typed, F.coalesce(*checks).alias("reject_reason"))


def accepts(df: DataFrame, table: str) -> list[Column]:
    """The conditions of a row that ``validate`` gives no reject reason, each source read as often as needed.

    The optimiser moves a filter down to the scan and writes every column's own expression into it,
    once per mention, so a present check that a conversion implies is left out: no conversion turns
    a missing or empty text into a value.
    """
    contract = CONTRACTS[table]
    converted = [(src, conv) for _, src, conv in contract.fields if conv is not _same]
    implied = {src for src, _ in converted}
    good = [present(df, c) for c in contract.required if c not in implied]
    for src, conv in converted:
        value = (_has_category if conv is icd9_category else lambda c: conv(c).isNotNull())(src)
        good.append(value if src in contract.required else F.col(src).isNull() | value)
    return good


def _has_category(c: str) -> Column:
    """Whether ``icd9_category`` gives a value, from one trimming."""
    return F.length(jvm_trim(c)) > 0


def to_records(df: DataFrame, table: str) -> DataFrame:
    """Good rows only, typed fields only (and the split or ``odd_id`` where there is one)."""
    keep = [c for c in ("split", ODD_ID) if c in df.columns]
    typed = [conv(src).alias(n) for n, src, conv in CONTRACTS[table].fields if not n.startswith("_")]
    return df.filter(accepted(df, table)).select(*keep, *typed)


def accepted(df: DataFrame, table: str) -> Column:
    """Whether a row meets its table's contract (never null)."""
    return reduce(lambda a, b: a & b, accepts(df, table))


def with_odd_id(df: DataFrame) -> DataFrame:
    """``odd_id``: the patient id as written where it is not the plain text of its number (`` 7``,
    ``07``), null for all others, whose text the number gives back."""
    written = F.col("SUBJECT_ID").cast("string")
    return df.withColumn(ODD_ID, F.when(written != to_long("SUBJECT_ID").cast("string"), written))


def rejects(df: DataFrame, table: str, stage: str = "records", earlier: str | None = None) -> DataFrame:
    """Rows that fail the contract, with the reason.

    ``earlier``: a column with the reason for which the prepare stage rejected a row
    already, null where it did not; it comes first.
    """
    v = validate(df, table, (earlier,) if earlier else ())
    early = F.col(earlier) if earlier else F.lit(None).cast("string")
    v = v.withColumn("reject_stage", F.when(early.isNotNull(), F.lit("prepare")).otherwise(F.lit(stage)))
    v = v.withColumn("reject_reason", F.coalesce(early, "reject_reason")).filter(F.col("reject_reason").isNotNull())
    return v.select(
        F.lit(table).alias("table_name"),
        F.col("reject_stage").alias("stage"),
        (F.col("split") if "split" in df.columns else F.lit(None).cast("string")).alias("split"),
        F.col("raw_subject_id").alias("subject_id"),
        (F.col("raw_hadm_id") if "HADM_ID" in df.columns else F.lit(None).cast("string")).alias("hadm_id"),
        F.col("reject_reason").alias("reason"),
    )


def fill_los(icustays: DataFrame) -> DataFrame:
    """P2 + P3: LOS as double, unparsable or missing -> 0."""
    return icustays.withColumn("LOS", to_double("LOS")).fillna(0.0, subset=["LOS"])


def parse_lab_values(labevents: DataFrame) -> DataFrame:
    """VALUENUM as double (unparsable -> NULL)."""
    return labevents.withColumn("VALUENUM", to_double("VALUENUM"))


def drop_null_values(labevents: DataFrame) -> DataFrame:
    """Labs without a numeric value are removed (after the cast)."""
    return labevents.filter(F.col("VALUENUM").isNotNull())


def with_label(patients: DataFrame) -> DataFrame:
    """IS_DEAD from the death date."""
    return patients.withColumn("IS_DEAD", derive_label("DOD_HOSP"))
