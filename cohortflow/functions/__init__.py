"""Column-level functions (no DataFrame in, Column out).

Everything here is a built-in Spark expression so it stays inside whole-stage
codegen; none of these functions runs Python per row.
"""

from cohortflow.functions.text import (
    ICU_TOKEN,
    icd9_category,
    infer_table_name,
    infer_table_name_col,
    jvm_trim,
    norm_token,
)
from cohortflow.functions.cast import (
    DAY_MS,
    admit_day_millis,
    derive_label,
    to_double,
    to_int,
    to_long,
)
from cohortflow.functions.scores import argmax, assert_finite, sigmoid, sigmoid_score

__all__ = [
    "ICU_TOKEN",
    "DAY_MS",
    "icd9_category",
    "infer_table_name",
    "infer_table_name_col",
    "jvm_trim",
    "norm_token",
    "admit_day_millis",
    "derive_label",
    "to_double",
    "to_int",
    "to_long",
    "argmax",
    "assert_finite",
    "sigmoid",
    "sigmoid_score",
]
