"""Long-format features (U1, J2-J6 -> C3).

The four event domains are unioned first, looked up in the vocabulary before
anything is shuffled (unknown tokens are gone and token strings never move), and
joined to the admissions once instead of once per domain.  Lookup sides are
stage tables, so Spark broadcasts them by its own byte threshold when they are
small and shuffles them when they are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.functions.cast import admit_day_millis, to_long
from cohortflow.functions.text import ICU_TOKEN, icd9_category, norm_token
from cohortflow.operators.clean import ODD_ID, present
from cohortflow.operators.skew import heavy_keys, salted_join
from cohortflow.session import materialize


def _keep(df: DataFrame) -> list[str]:
    return ["split"] if "split" in df.columns else []


def all_events(diagnoses: DataFrame, medications: DataFrame, labs: DataFrame, icustays: DataFrame) -> DataFrame:
    """(split?, odd_id?, patient_id, hadm_id, domain, token, value) of every domain.

    Presence features have value 1.0; labs carry their (normalised) value and
    ICU stays their length under the constant ICU token.
    """
    k = _keep(diagnoses) + [c for c in (ODD_ID,) if c in diagnoses.columns]
    diag = diagnoses.select(
        *k, "patient_id", "hadm_id", F.lit("diagnosis").alias("domain"),
        icd9_category("code").alias("token"), F.lit(1.0).alias("value"),
    )
    med = medications.select(
        *k, "patient_id", "hadm_id", F.lit("medication").alias("domain"),
        norm_token("drug").alias("token"), F.lit(1.0).alias("value"),
    )
    lab = labs.select(
        *k, "patient_id", "hadm_id", F.lit("lab").alias("domain"),
        norm_token("item").alias("token"), F.col("value").cast("double").alias("value"),
    )
    icu = icustays.select(
        *k, "patient_id", "hadm_id", F.lit("icu").alias("domain"),
        F.lit(ICU_TOKEN).alias("token"), F.col("los").cast("double").alias("value"),
    )
    return diag.unionByName(med).unionByName(lab).unionByName(icu)


def index_features(events: DataFrame, vocab: DataFrame, namespaced: bool = False) -> DataFrame:
    """J3 + J4: events with ``feature_id`` in place of domain and token.

    Unknown tokens are dropped by the inner join.  With ``namespaced`` the
    vocabulary keeps one id per (domain, token) and the lookup uses both.
    """
    on = ["domain", "token"] if namespaced else ["token"]
    rest = [c for c in events.columns if c not in ("domain", "token", "value")]
    return events.join(vocab.select(*on, "feature_id"), on, "inner").select(*rest, "feature_id", "value")


def attach_visit(events: DataFrame, admissions: DataFrame, salted: bool = False) -> DataFrame:
    """Admission day (``admit_ms``) of each event in place of its admission id.

    Inner equi-join on (patient_id, hadm_id); events without an admission drop
    out, and a duplicated admission row multiplies its events, as a relational
    join does.  With ``salted`` an admission that owns many events is found before
    the join and dealt to many tasks by it.
    """
    adm = admissions.select("patient_id", "hadm_id", "admit_ms")
    rest = [c for c in events.columns if c not in ("split", "patient_id", "hadm_id")]
    keys = ["patient_id", "hadm_id"]
    joined = salted_join(events, adm, keys, heavy_keys(events, keys)) if salted else events.join(adm, keys, "inner")
    return joined.select(*_keep(events), "patient_id", "admit_ms", *rest)


def attach_labelled_visit(events: DataFrame, admissions: DataFrame, patients: DataFrame, salted: bool = False) -> DataFrame:
    """J2 + J6: ``attach_visit`` for the events of patients with a row in ``patients`` (split?, patient_id).

    The admissions are limited to those patients, per split, so the events are shuffled once
    and not a second time for the semi-join.
    """
    k = _keep(events)
    who = patients.select(*k, "patient_id").distinct()
    adm = admissions.select("patient_id", "hadm_id", "admit_ms").join(who, "patient_id")
    rest = [c for c in events.columns if c not in ("split", "patient_id", "hadm_id")]
    # One narrow row per admission: hashed after the shuffle, so that the events need no sort.
    keys = ["hadm_id", "patient_id", *k]
    joined = salted_join(events, adm, keys, heavy_keys(events, keys)) if salted else events.join(adm.hint("shuffle_hash"), keys, "inner")
    return joined.select(*k, "patient_id", "admit_ms", *rest)


# ---------------------------------------------------------------- J1 + J2 in one shuffle
#
# An admission names its patient, so what an event gets from the cohort (J1), from its
# admission (J2) and from its patient's label row (J5, J6) is joined to the narrow admissions
# first; the events are shuffled once for all three.  Events that name no admission on
# file, or write their patient's id in another way, are joined to the cohort on their own.


def marked_cohort(cohort: DataFrame, marks: DataFrame) -> DataFrame:
    """(SUBJECT_ID, split, mark) of the cohort; ``marks``: (split, patient_id, mark), one row per
    patient and split, the mark null for a patient without one."""
    ids = cohort.select("SUBJECT_ID", "split", to_long("SUBJECT_ID").alias("patient_id"))
    return ids.join(marks.select("split", "patient_id", "mark"), ["patient_id", "split"], "left").select("SUBJECT_ID", "split", "mark")


def stays(admissions: DataFrame, ids: DataFrame) -> DataFrame:
    """(patient_id, hadm_id, known, split, mark, admit_ms): what an event gets from its admission.

    ``admissions`` is the raw table, ``ids`` the ``marked_cohort``.  One row per admission record
    of the cohort; an admission without one (another patient's, or without a date) has one
    row with a null day.  ``known``: the patient is written plainly there, so that
    ``split`` and ``mark`` are the patient's (null: not of the cohort).
    """
    patient, written = to_long("SUBJECT_ID"), F.col("SUBJECT_ID").cast("string")
    rows = admissions.filter(patient.isNotNull() & present(admissions, "HADM_ID"))
    # The contract's conversions before the join: a date is shuffled as a number.
    rows = rows.select(
        "SUBJECT_ID", patient.alias("patient_id"), F.col("HADM_ID").cast("string").alias("hadm_id"),
        (written == patient.cast("string")).alias("plain"), admit_day_millis("ADMITTIME").alias("day"),
    )
    rows = rows.join(ids, "SUBJECT_ID", "left").withColumn("day", F.when(F.col("split").isNotNull(), F.col("day")))
    # One order for all: the null days of an admission come first, and one of them stays where it has no other.
    w = Window.partitionBy("hadm_id", "patient_id").orderBy("day")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.col("plain")
    rows = rows.select(
        "patient_id", "hadm_id", F.max("plain").over(every).alias("known"), F.max(F.when(own, F.col("split"))).over(every).alias("split"),
        F.max(F.when(own, F.col("mark"))).over(every).alias("mark"), F.col("day").alias("admit_ms"),
        F.max("day").over(every).alias("_last"), F.row_number().over(w).alias("_row"),
    )
    return rows.filter(F.col("admit_ms").isNotNull() | (F.col("_last").isNull() & (F.col("_row") == 1))).drop("_last", "_row")


def placed_events(events: DataFrame, stays: DataFrame) -> DataFrame:
    """Events (``all_events`` with ``odd_id``) with what their admission gives them.

    (split, patient_id, admit_ms, domain, token, value, mark, loose_id); ``loose_id`` is the patient
    id as written where the cohort has still to be asked (``settled_events``), null elsewhere.
    Events of known patients outside the cohort are gone.  Left equi-join: a duplicated
    admission multiplies its events, an event without one has a null day.
    """
    # One narrow row per admission: hashed after the shuffle, so that the events need no sort.
    joined = events.join(stays.hint("shuffle_hash"), ["hadm_id", "patient_id"], "left")
    settled = F.coalesce("known", F.lit(False)) & F.col(ODD_ID).isNull()
    loose = F.when(~settled, F.coalesce(ODD_ID, F.col("patient_id").cast("string")))
    joined = joined.filter(~settled | F.col("split").isNotNull())
    return joined.select("split", "patient_id", "admit_ms", "domain", "token", "value", "mark", loose.alias("loose_id"))


def settled_events(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """J1 of the loose rows: (split, patient_id, admit_ms, domain, token, value, mark) of the cohort.

    ``placed`` is a stage table: where it has no loose row, as its statistics tell, it is the result.
    """
    loose, columns = F.col("loose_id"), [c for c in placed.columns if c != "loose_id"]
    own = placed.filter(loose.isNull()).select(*columns)
    rest = placed.filter(loose.isNotNull())
    if rest.isEmpty():
        return own
    found = rest.drop("split", "mark").join(ids, F.col("loose_id") == F.col("SUBJECT_ID"))
    return own.unionByName(materialize(found.select(*columns)))


def unknown_tokens(events: DataFrame, vocab: DataFrame, namespaced: bool = False) -> DataFrame:
    """J4 report: (split?, domain, token, n_events) of tokens not in the vocabulary."""
    return count_tokens(unknown_events(events, vocab, namespaced))


def unknown_events(events: DataFrame, vocab: DataFrame, namespaced: bool = False) -> DataFrame:
    """The events whose token is not in the vocabulary: as a rule a small part of all."""
    on = ["domain", "token"] if namespaced else ["token"]
    return events.join(vocab.select(*on), on, "left_anti").select(*events.columns)


def count_tokens(events: DataFrame) -> DataFrame:
    """(split?, domain, token, n_events)."""
    return events.groupBy(*_keep(events), "domain", "token").agg(F.count(F.lit(1)).cast("bigint").alias("n_events"))


def patients_with_features(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Label rows of patients that kept at least one feature.

    The feature side is reduced to distinct patients first (partial
    aggregation before the shuffle), so the semi-join moves one row per
    patient and map task, not one per event.
    """
    keys = _keep(labels) + ["patient_id"]
    present = features.select(*keys).distinct()
    return labels.join(present, keys, "left_semi")


def features_of_labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of patients that have a label."""
    keys = _keep(features) + ["patient_id"]
    return features.join(labels.select(*keys), keys, "left_semi")
