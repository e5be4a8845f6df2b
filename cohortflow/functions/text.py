"""Token normalisation and name helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference for equal results ----------
# Feature name given to the length-of-ICU-stay value.
ICU_TOKEN = "ICUStayDuration"
# Table-name pattern: the last run of word characters before an optional
# ".csv" at the end of the path.
TABLE_NAME_PATTERN = r"(\w+)(\.csv)?$"
# ---------------------------------------------------------------------------

# A JVM String.trim() strips every char <= U+0020, Spark's trim() only blanks.
_JVM_BLANKS = "".join(chr(i) for i in range(0x21))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c) -> Column:
    """Strip leading/trailing characters in U+0000..U+0020 (tab, CR, LF...)."""
    return F.btrim(_col(c), F.lit(_JVM_BLANKS))


def norm_token(c) -> Column:
    """Trim (JVM rules) then lower-case: medication and lab item tokens."""
    return F.lower(jvm_trim(c))


def icd9_category(c) -> Column:
    """Roll an ICD-9 code up to its category.

    Trimmed code starting with ``E`` keeps 4 characters, any other keeps 3.
    A code that is empty after trimming has no category (NULL), which the
    record contract reports as a reject instead of failing the job.
    """
    t = jvm_trim(c)
    # Both mentions of the trimmed code are always evaluated, so Spark trims it once.
    cut = F.substr(t, F.lit(1), F.when(t.startswith("E"), F.lit(4)).otherwise(F.lit(3)))
    return F.nullif(cut, F.lit(""))


def infer_table_name(path: str) -> str:
    """Table name from a file path; the whole path when nothing matches."""
    m = re.search(TABLE_NAME_PATTERN, path, re.ASCII)
    return m.group(1) if m else path


def infer_table_name_col(c) -> Column:
    """Column form of :func:`infer_table_name`, e.g. over ``input_file_name()``."""
    p = _col(c)
    name = F.regexp_extract(p, TABLE_NAME_PATTERN, 1)
    return F.when(name == "", p).otherwise(name)
