"""Cohort, split and per-split normalisation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.skew import heavy_keys, salted_join
from cohortflow.schemas import DEFAULT_SEED, DEFAULT_WEIGHTS, SPLITS

BUCKETS = 1 << 32  # the split bucket is the first 32 bits of an md5


def icu_cohort(icustays: DataFrame) -> DataFrame:
    """A1: distinct patients with at least one ICU stay id."""
    return (
        icustays.filter(F.col("ICUSTAY_ID").isNotNull() & F.col("SUBJECT_ID").isNotNull())
        .select("SUBJECT_ID")
        .distinct()
    )


def split_bucket(key, seed: int = DEFAULT_SEED) -> Column:
    """Deterministic bucket in [0, 2^32) from an md5 of ``key:seed``."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.substring(F.md5(F.concat(k.cast("string"), F.lit(f":{seed}"))), 1, 8)
    return F.conv(h, 16, 10).cast("bigint")


def split_thresholds(weights=DEFAULT_WEIGHTS) -> list[int]:
    """Integer upper bounds of each split's bucket range (exact comparisons)."""
    total = float(sum(weights))
    cum, out = 0.0, []
    for w in weights:
        cum += w
        out.append(int(math.floor(cum / total * BUCKETS)))
    out[-1] = BUCKETS
    return out


def split_of(key, weights=DEFAULT_WEIGHTS, seed: int = DEFAULT_SEED, names=SPLITS) -> Column:
    """Split name of a key; independent of partitioning and row order."""
    b = split_bucket(key, seed)
    bounds = split_thresholds(weights)
    expr = None
    for name, hi in zip(names, bounds):
        expr = F.when(b < F.lit(hi), F.lit(name)) if expr is None else expr.when(b < F.lit(hi), F.lit(name))
    return expr


def split_cohort(
    cohort: DataFrame,
    weights=DEFAULT_WEIGHTS,
    seed: int = DEFAULT_SEED,
    names=SPLITS,
    method: str = "hash",
) -> DataFrame:
    """(SUBJECT_ID, split).  ``method="random"`` keeps ``randomSplit``."""
    if method == "hash":
        return cohort.withColumn("split", split_of("SUBJECT_ID", weights, seed, names))
    if method == "random":
        parts = cohort.randomSplit(list(map(float, weights)), seed=seed)
        out = None
        for name, part in zip(names, parts):
            p = part.withColumn("split", F.lit(name))
            out = p if out is None else out.unionByName(p)
        return out
    raise ValueError(f"unknown split method {method!r}")


def restrict_to_cohort(df: DataFrame, cohort_split: DataFrame, salted: bool = False) -> DataFrame:
    """Rows of cohort patients, tagged with the patient's split.

    The cohort is a stage table, so Spark knows its size: a small one is
    broadcast by Spark's own byte threshold, a larger one is a shuffle join
    (AQE splits a hot patient's partition).  With ``salted`` the patients that own
    many rows are found before the join and dealt to many tasks by it.
    """
    patients = cohort_split.select("SUBJECT_ID", "split")
    if salted:
        return salted_join(df, patients, ["SUBJECT_ID"], heavy_keys(df, ["SUBJECT_ID"]))
    return df.join(patients, "SUBJECT_ID", "inner")


def split_max(labs: DataFrame, by: str = "split", value: str = "VALUENUM") -> DataFrame:
    """A2: maximum lab value per split over all items (one row per split)."""
    return labs.groupBy(by).agg(F.max(value).alias("max_value"))


def cohort_max(labs: DataFrame, cohort_split: DataFrame, by: str = "split", value: str = "VALUENUM") -> DataFrame:
    """A2 of a cohort's labs from the labs of all patients: the largest value per patient comes
    first, so that one row per patient is joined to the cohort and not one per lab."""
    each = labs.groupBy("SUBJECT_ID").agg(F.max(value).alias(value)).filter(F.col(value).isNotNull())
    return split_max(restrict_to_cohort(each, cohort_split), by, value)


def max_normalize(labs: DataFrame, by: str = "split", value: str = "VALUENUM", maxima: DataFrame | None = None) -> DataFrame:
    """Value / max(value) of its split; an empty split or max 0 -> NULL.

    The maxima table has one row per split, a proven bound, so it is
    broadcast back; no driver round trip.  ``maxima``: the ``split_max`` of ``labs`` where
    the caller has a cheaper way to it.
    """
    maxima = split_max(labs, by, value) if maxima is None else maxima
    return (
        labs.join(F.broadcast(maxima), by, "inner")
        .withColumn(value, F.try_divide(F.col(value), F.col("max_value")))
        .drop("max_value")
    )


def normalized_events(events: DataFrame, maxima: DataFrame) -> DataFrame:
    """P12 on event rows: lab values divided by their split's maximum (``split_max``); a lab without
    a usable quotient drops out, other domains stay as they are."""
    lab = F.col("domain") == "lab"
    columns = events.columns
    joined = events.join(F.broadcast(maxima), "split", "left")
    value = F.when(lab, F.try_divide("value", "max_value")).otherwise(F.col("value"))
    return joined.withColumn("value", value).filter(~lab | F.col("value").isNotNull()).select(*columns)
