"""Composite operators C1-C6: the user-facing pipeline.

One DataFrame per table carries a ``split`` column instead of one table per
split, so every stage runs once for all splits.  Tables are built on first
access, so a caller pays only for what it reads; small derived tables that
several stages read (cohort, vocabulary, labels) are written in the shared
checkpoint folder, where Spark knows their size and picks each join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators import clean, cohort as C, features as FT, sequences as S, vocab as V
from cohortflow.operators import metrics as M
from cohortflow.operators import model as ML
from cohortflow.schemas import DEFAULT_SEED, DEFAULT_WEIGHTS, PREPARED_COLUMNS, SPLITS
from cohortflow.session import Lazy, materialize, materialize_at, release_tables
from cohortflow.sources.csv import read_raw_tables
from cohortflow.sources.sinks import write_prepared

TABLES = ("admissions", "diagnoses", "icustays", "labevents", "patients", "prescriptions")


class PreparedTables(Lazy):
    """The prepared tables, and what they were prepared from."""

    def __init__(self, builders, prep: Prepared):
        super().__init__(builders)
        self.prep = prep


class Prepared:
    """C1 output: cohort, prepared tables and tagged labs, each built on first access."""

    def __init__(self, raw, weights, seed, names, method, normalize_labs=True, salted=False):
        self.raw, self._split, self.salted, self.normalized = raw, (weights, seed, names, method), salted, normalize_labs
        builders = {
            "admissions": lambda: self.restrict(raw["admissions"]),
            "diagnoses": lambda: self.restrict(raw["diagnoses"]),
            "icustays": lambda: self.restrict(clean.fill_los(raw["icustays"])),
            "labevents": lambda: self.labs(normalize_labs),
            "patients": lambda: self.restrict(clean.with_label(raw["patients"]).select("SUBJECT_ID", "IS_DEAD")),
            "prescriptions": lambda: self.restrict(raw["prescriptions"]),
        }
        self.tables = PreparedTables({t: (lambda t=t: builders[t]().select(*PREPARED_COLUMNS[t], "split")) for t in TABLES}, self)

    @cached_property
    def cohort(self) -> DataFrame:
        weights, seed, names, method = self._split
        return materialize(C.split_cohort(C.icu_cohort(self.raw["icustays"]), weights, seed, names, method))

    def restrict(self, df: DataFrame) -> DataFrame:
        return C.restrict_to_cohort(df, self.cohort, self.salted)

    def labs(self, normalize: bool) -> DataFrame:
        """Labs of the cohort that have a number, divided by their split's largest one."""
        parsed = clean.parse_lab_values(self.raw["labevents"])
        labs = clean.drop_null_values(self.restrict(parsed))
        return C.max_normalize(labs, maxima=C.cohort_max(parsed, self.cohort)) if normalize else labs

    def visit_events(self, marks: DataFrame) -> DataFrame:
        """U1 + J1 + J2: (split, patient_id, admit_ms, domain, token, value, mark), the event rows of the
        cohort with their visit day, labs as measured.

        The rows of ``all_events`` over the records of the prepared tables, left-joined to the
        admission records and to ``marks`` ((split, patient_id, mark), one row each), but
        shuffled once and not once per join (``features.placed_events``).
        """
        raw = self.raw
        ids = materialize(FT.marked_cohort(self.cohort, marks))
        stays, path = materialize_at(FT.stays(raw["admissions"], ids))
        sources = {
            "diagnoses": raw["diagnoses"], "prescriptions": raw["prescriptions"],
            "labevents": clean.parse_lab_values(raw["labevents"]), "icustays": clean.fill_los(raw["icustays"]),
        }
        recs = {t: clean.to_records(clean.with_odd_id(df), t) for t, df in sources.items()}
        events = FT.all_events(recs["diagnoses"], recs["prescriptions"], recs["labevents"], recs["icustays"])
        placed = materialize(FT.placed_events(events, stays))
        release_tables([path])
        return FT.settled_events(placed, ids)

    def lab_maxima(self, events: DataFrame) -> DataFrame:
        """A2 from ``visit_events``: their largest lab per split, or that of the cohort's labs with a
        number that are no records (without an admission id, say), whichever is larger."""
        labs = clean.parse_lab_values(self.raw["labevents"])
        rest = C.cohort_max(labs.filter(F.col("VALUENUM").isNotNull() & ~clean.accepted(labs, "labevents")), self.cohort)
        own = C.split_max(events.filter("domain = 'lab'"), value="value")
        return C.split_max(own.unionByName(rest), value="max_value")

    @cached_property
    def tagged_labs(self) -> DataFrame:
        """Every lab of the cohort, normalised, with the reason ``_early`` that ``prepare`` drops it for."""
        raw, number = F.col("VALUENUM"), F.col("VALUENUM").try_cast("double")
        early = F.when(raw.isNull(), F.lit("missing VALUENUM")).when(number.isNull(), F.lit("bad VALUENUM"))
        labs = self.restrict(self.raw["labevents"]).withColumn("_early", early).withColumn("VALUENUM", number)
        # One row per split: a split without any number has none.
        maxima = F.broadcast(C.split_max(clean.drop_null_values(labs)))
        return labs.join(maxima, "split", "left").withColumn("VALUENUM", F.try_divide("VALUENUM", "max_value")).drop("max_value")


def prepare(raw, weights=DEFAULT_WEIGHTS, seed: int = DEFAULT_SEED, names=SPLITS, method: str = "hash", normalize_labs: bool = True, salted: bool = False) -> Prepared:
    """Clean -> ICU cohort -> split by patient -> restrict -> normalise labs.

    ``raw`` maps table names to raw frames; output tables hold the prepared
    columns plus ``split``.  With ``normalize_labs=False`` labs stay as measured (a
    fitted bundle divides them by the maxima it saves).  ``salted`` looks for patients
    that own many rows before each join (one more pass over each table), for sessions
    without AQE's skew handling.
    """
    return Prepared(raw, weights, seed, names, method, normalize_labs, salted)


def prepare_files(spark: SparkSession, folder: str, out: str, weights=DEFAULT_WEIGHTS, seed: int = DEFAULT_SEED, fmt: str = "parquet") -> Prepared:
    """C1 + K4 in one call: the raw CSV folder to ``out/<table>/split=<split>/``."""
    prep = prepare(read_raw_tables(spark, folder), weights, seed)
    write_prepared(prep.tables, out, fmt)
    return prep


class Records(Lazy):
    """Typed records by table, and the event rows of all of them.

    ``prep``: what the records were prepared from, where that is at hand.
    """

    def __init__(self, builders, prep: Prepared | None = None):
        super().__init__(builders)
        self.prep = prep

    @cached_property
    def events(self) -> DataFrame:
        # Written once: the vocabulary and the features read the same cleaned tokens,
        # so every raw table is joined to the cohort and checked one time.
        return materialize(FT.all_events(self["diagnoses"], self["prescriptions"], self["labevents"], self["icustays"]))


    @cached_property
    def visit_events(self) -> DataFrame | None:
        """(split, patient_id, admit_ms, domain, token, value, mark): ``events`` with their visit day, the
        mark null where the patient has no label row in the split; None if the records do not
        come from ``prepare`` (with labs normalised), or with salted joins."""
        prep = self.prep
        if prep is None or prep.salted or not prep.normalized:
            return None
        labelled = self["patients"].select("split", "patient_id").distinct().withColumn("mark", F.lit(1))
        measured = prep.visit_events(labelled)
        return C.normalized_events(measured, materialize(prep.lab_maxima(measured)))


def records(prepared) -> Records:
    """P5 + P7 for every prepared table: typed records, rejects left out."""
    return Records({t: (lambda t=t: clean.to_records(prepared[t], t)) for t in prepared}, getattr(prepared, "prep", None))


def rejects_report(prep: Prepared) -> DataFrame:
    """Every row the pipeline rejects, with table, stage, split and reason.

    Each table is scanned once; labs that ``prepare`` drops and labs that fail their
    contract come out of the same scan.
    """
    out = clean.rejects(prep.tagged_labs, "labevents", earlier="_early")
    for t in prep.tables:
        if t != "labevents":
            out = out.unionByName(clean.rejects(prep.tables[t], t))
    return out


@dataclass
class Vocabulary:
    table: DataFrame
    namespaced: bool = False

    @cached_property
    def width(self) -> int:
        """Length of a feature vector: every id of the vocabulary fits."""
        return int(self.table.agg(F.max("feature_id")).first()[0]) + 1


def build_vocabulary(recs, split: str = "train", namespaced: bool = False) -> Vocabulary:
    """Vocabulary from one split's records (the training split).

    Records that hold their event rows (``Records.events``) lend them, so that a data set built on
    them reads the same table; for the vocabulary alone pass the tables as a plain mapping.
    """
    if isinstance(recs, Records):
        events = recs.events if recs.visit_events is None else recs.visit_events
        return Vocabulary(materialize(V.vocabulary_of_tokens(events.filter(F.col("split") == split), namespaced)), namespaced)

    def one(t: str) -> DataFrame:
        return recs[t].filter(F.col("split") == split)

    return Vocabulary(materialize(V.build_vocab(one("diagnoses"), one("prescriptions"), one("labevents"), namespaced)), namespaced)


class Dataset:
    """C3 output: features of patients with a label, and those patients' labels."""

    def __init__(self, recs, vocab: Vocabulary, salted: bool = False):
        self.recs, self.vocab, self.salted = recs, vocab, salted

    @cached_property
    def source_events(self) -> DataFrame:
        r = self.recs
        if isinstance(r, Records):
            return r.events
        return FT.all_events(r["diagnoses"], r["prescriptions"], r["labevents"], r["icustays"])

    @cached_property
    def events(self) -> DataFrame:
        """Events with their visit day, before the vocabulary."""
        return FT.attach_visit(self.source_events, self.recs["admissions"], self.salted)

    @cached_property
    def visit_events(self) -> DataFrame | None:
        """Event rows that have their visit day already (``Records.visit_events``)."""
        found = self.recs.visit_events if isinstance(self.recs, Records) and not self.salted else None
        return None if found is None else found.filter(F.col("admit_ms").isNotNull())

    @cached_property
    def unknown_tokens(self) -> DataFrame:
        """J4 report of events with a visit; known events leave before the visit join."""
        if self.visit_events is not None:
            return FT.count_tokens(FT.unknown_events(self.visit_events, self.vocab.table, self.vocab.namespaced))
        unknown = FT.unknown_events(self.source_events, self.vocab.table, self.vocab.namespaced)
        return FT.count_tokens(FT.attach_visit(unknown, self.recs["admissions"], self.salted))

    @cached_property
    def features(self) -> DataFrame:
        # Looked up first (unknown tokens and token strings are never shuffled),
        # then joined, once, to the visits of the labelled patients.
        # Written once: labels, sequences, cells and vectors all read it.
        if self.visit_events is not None:
            known = FT.index_features(self.visit_events.filter(F.col("mark").isNotNull()).drop("mark"), self.vocab.table, self.vocab.namespaced)
            return materialize(known)
        found = FT.index_features(self.source_events, self.vocab.table, self.vocab.namespaced)
        return materialize(FT.attach_labelled_visit(found, self.recs["admissions"], self.recs["patients"], self.salted))

    @cached_property
    def labels(self) -> DataFrame:
        """(split, patient_id, is_dead) of patients that kept a feature."""
        return materialize(FT.patients_with_features(self.recs["patients"].select("split", "patient_id", "is_dead"), self.features))


def build_dataset(recs, vocab: Vocabulary, salted: bool = False) -> Dataset:
    """Long features (split, patient_id, admit_ms, feature_id, value) and labels."""
    return Dataset(recs, vocab, salted)


def build_sequences(ds: Dataset, visits_per_row: int = S.VISITS_PER_ROW) -> DataFrame:
    """C4: labelled sequences (split, patient_id, chunk, first_visit, first_entry, seq, label).

    A patient with two label rows fails the job (one label per patient is the contract).
    """
    return S.sequences(ds.features, visits_per_row, labels=ds.labels)


def patient_vector_table(ds: Dataset, width: int, how: str = "sum", pooled: DataFrame | None = None) -> DataFrame:
    """X3 vectors joined with labels: (split, patient_id, label, features).

    A stage table: every labelled patient has a row; one without cells has an empty vector.
    ``pooled``: the pooled cells, where the caller has them written.
    """
    if pooled is None:
        pooled = S.pool_sequences(S.visit_matrix(ds.features), how)
    labels = ds.labels.select("split", "patient_id", F.col("is_dead").cast("int").alias("label"))
    joined = labels.join(S.assembled(pooled, ["split", "patient_id"], width, "features"), ["split", "patient_id"], "left")
    nothing = S.sparse_parts(width, F.array(), F.array())
    return S.as_vectors(joined.select("split", "patient_id", "label", F.coalesce("features", nothing).alias("features")), "features")


def scored_patients(ds: Dataset, coefficients: DataFrame, intercept: float = 0.0, how: str = "sum") -> DataFrame:
    """L3 for a linear model: pooled cells joined to its coefficient table.

    (split, patient_id, label, logit, score, prediction) of every labelled
    patient; fitted and given coefficients (feature_id, weight) take the same path.
    """
    pooled = S.pool_sequences(S.visit_matrix(ds.features), how)
    return ML.linear_scores(pooled, ds.labels, coefficients, intercept)


def fit_bundle(raw, weights=DEFAULT_WEIGHTS, seed: int = DEFAULT_SEED, **settings):
    """K5 + C2 + P12 + L1: clean, split, learn; the result is one object to save and load.

    ``settings``: parameters of ``CohortEstimator`` (pooling, kind, regParam, maxIter, ...).
    Returns the fitted ``CohortModel`` and the event rows of all splits.
    """
    from cohortflow.plans import bundle as B

    prep = prepare(raw, weights, seed, normalize_labs=False)
    events = B.event_rows(records(prep.tables))
    maxima = B.lab_maxima(prep.lab_maxima(events))
    # The event rows are a table already: the estimator need not write them again.
    return B.CohortEstimator(labMaxima=maxima, held=True, **settings).fit(events), events


def score_new_patients(model, raw) -> DataFrame:
    """L3 for raw tables of patients the run never saw, with everything it saved.

    (split = ``new``, patient_id, label, logit, score, prediction); the label is null where
    the patients table has none for the patient.
    """
    from cohortflow.plans import bundle as B

    return model.transform(B.new_event_rows(raw))


@dataclass
class ModelRun:
    model: object
    width: int
    vectors: DataFrame
    report: ML.Report
    validation: DataFrame
    curve: DataFrame
    best: int


def run_model(ds: Dataset, kind: str = "logistic", how: str = "sum", epochs=(5, 10, 20, 50), folder: str | None = None) -> ModelRun:
    """Train by epochs, keep the first epoch that is best on validation, report on test.

    ``epochs`` are iteration budgets; each epoch is fitted from the same start, so epoch
    e is the model after that many iterations.  Every epoch's model is saved, the
    curve holds loss and accuracy of both phases, and the chosen model is read
    back for the report.
    """
    width = ds.vocab.width
    # Written once, read by every fit, scoring and report table.
    vectors = patient_vector_table(ds, width, how)
    fitted = ML.train_epochs(vectors, width, kind, epochs, folder)
    curve = fitted.curve
    chosen = M.best_epoch(curve.filter(F.col("phase") == "valid")).first()
    best = int(chosen["epoch"]) if chosen else len(epochs) - 1
    model = ML.load_epoch(fitted, best)
    valid = ML.evaluate(model, vectors.filter(F.col("split") == "valid"))
    return ModelRun(model, width, vectors, ML.report(model, vectors.filter(F.col("split") == "test"), curve=curve), valid, curve, best)
