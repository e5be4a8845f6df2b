"""Fitted bundle (K5 + C2 + P12): everything a run learns, in one saved object.

``CohortEstimator`` learns from event rows: the largest lab value (per split), the
vocabulary with its width, and the classifier.  ``CohortModel`` holds the three, is saved
and loaded as one folder (Spark ML metadata, parquet tables), and scores event rows of
patients it has never seen: labs divided by the saved maximum, tokens looked up in the
saved vocabulary, cells pooled, coefficients joined.

Event rows are (split, patient_id, admit_ms, domain, token, value, label): one row per
diagnosis, drug, lab result (as measured) and ICU stay; ``event_rows`` makes them from
records, ``new_event_rows`` from raw tables.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.operators import clean, cohort as C, features as FT, metrics as M, model as ML, sequences as S, vocab as V
from cohortflow.session import materialize

COLUMNS = ["split", "patient_id", "admit_ms", "domain", "token", "value", "label"]


# ---------------------------------------------------------------- event rows


def event_rows(recs) -> DataFrame:
    """Event rows of records whose labs were not normalised (``prepare(..., normalize_labs=False)``).

    An event without an admission keeps a null day: it counts for the vocabulary and
    nothing else.  A patient without a label row has a null label; two label rows fail.
    Records that hold what they were prepared from give a stage table, which the events
    reach in one shuffle.
    """
    prep = getattr(recs, "prep", None)
    if prep is not None and not prep.normalized and not prep.salted:
        marks = S.unique_labels(recs["patients"].select("split", "patient_id", "is_dead")).withColumnRenamed("label", "mark")
        return prep.visit_events(marks).withColumnRenamed("mark", "label").select(*COLUMNS)
    events = FT.all_events(recs["diagnoses"], recs["prescriptions"], recs["labevents"], recs["icustays"])
    # One narrow row per admission: hashed after the shuffle, so that the events need no sort.
    admissions = recs["admissions"].select("patient_id", "hadm_id", "admit_ms").hint("shuffle_hash")
    # A stage table, so Spark knows its size: where it is small the events are not shuffled again for it.
    labels = materialize(S.unique_labels(recs["patients"].select("split", "patient_id", "is_dead")))
    joined = events.join(admissions, ["hadm_id", "patient_id"], "left").join(labels, ["patient_id", "split"], "left")
    return joined.select(*COLUMNS)


def new_event_rows(raw, split: str = "new") -> DataFrame:
    """Event rows of raw tables of new patients: no cohort, no split, a label where there is one."""
    tables = {
        "admissions": raw["admissions"],
        "diagnoses": raw["diagnoses"],
        "icustays": clean.fill_los(raw["icustays"]),
        "labevents": clean.drop_null_values(clean.parse_lab_values(raw["labevents"])),
        "patients": clean.with_label(raw["patients"]).select("SUBJECT_ID", "IS_DEAD"),
        "prescriptions": raw["prescriptions"],
    }
    return event_rows({t: clean.to_records(df.withColumn("split", F.lit(split)), t) for t, df in tables.items()})


def lab_maxima(labs: DataFrame) -> dict[str, float]:
    """The largest value of every split (one entry per split) of prepared labs, or of their maxima (``cohort_max``)."""
    maxima = labs if "max_value" in labs.columns else C.split_max(labs)
    return {r["split"]: float(r["max_value"]) for r in maxima.collect() if r["max_value"] is not None}


# ---------------------------------------------------------------- parameters


class _BundleParams(Params):
    pooling = Param(Params._dummy(), "pooling", "how visits are pooled: sum, mean, last or decay", TypeConverters.toString)
    kind = Param(Params._dummy(), "kind", "classifier: logistic or mlp", TypeConverters.toString)
    trainSplit = Param(Params._dummy(), "trainSplit", "split to learn from, and whose maximum serves splits without one", TypeConverters.toString)
    labMaxima = Param(Params._dummy(), "labMaxima", "largest lab value per split")
    regParam = Param(Params._dummy(), "regParam", "L2 penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations of the fit", TypeConverters.toInt)
    held = Param(Params._dummy(), "held", "whether the rows to learn from are a stored table, which fit reads as it is", TypeConverters.toBoolean)
    digits = Param(Params._dummy(), "digits", "decimals the logit is rounded to, -1 for none", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(pooling="sum", kind="logistic", trainSplit="train", regParam=ML.L2_DECAY, maxIter=100, digits=-1, held=False)

    def _maxima(self) -> dict[str, float]:
        return dict(self.getOrDefault(self.labMaxima)) if self.isDefined(self.labMaxima) else {}

    def _normalised(self, events: DataFrame, maxima: dict[str, float]) -> DataFrame:
        """P12 with given maxima; a lab without a usable quotient drops out, as in ``prepare``."""
        top = F.lit(maxima.get(self.getOrDefault(self.trainSplit))).cast("double")
        for split, value in sorted(maxima.items()):
            top = F.when(F.col("split") == split, F.lit(value)).otherwise(top)
        lab = F.col("domain") == "lab"
        value = F.when(lab, F.try_divide("value", top)).otherwise(F.col("value"))
        return events.withColumn("value", value).filter(~lab | F.col("value").isNotNull())

    def _pooled(self, found: DataFrame) -> DataFrame:
        return S.pool_sequences(S.visit_matrix(found), self.getOrDefault(self.pooling))


# ---------------------------------------------------------------- estimator


class CohortEstimator(Estimator, _BundleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns maxima (unless given), vocabulary and classifier from event rows."""

    @keyword_only
    def __init__(self, *, pooling=None, kind=None, trainSplit=None, labMaxima=None, regParam=None, maxIter=None, digits=None, held=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CohortModel:
        events = dataset.select(*COLUMNS)
        if not self.getOrDefault(self.held):
            events = materialize(events)
        train = self.getOrDefault(self.trainSplit)
        maxima = self._maxima()
        if not maxima:
            labs = events.filter("domain = 'lab'").select("split", F.col("value").alias("VALUENUM"))
            maxima = lab_maxima(labs)
        ready = self._normalised(events, maxima)
        vocabulary = materialize(V.vocabulary_of_tokens(ready.filter(F.col("split") == train)))
        width = int(vocabulary.agg(F.max("feature_id")).first()[0]) + 1
        model = CohortModel(vocabulary, width)
        self._copyValues(model)
        model._set(labMaxima=maxima)
        # The training rows' features: known tokens of patients with a label and a visit.
        own = ready.filter((F.col("split") == train) & F.col("label").isNotNull())
        pooled = self._pooled(model.features(own, normalised=True))
        labels = S.unique_labels(own.select("split", "patient_id", F.col("label").alias("is_dead")).distinct())
        parts = labels.join(S.assembled(pooled, ["split", "patient_id"], width, "features"), ["split", "patient_id"])
        vectors = S.as_vectors(parts, "features")
        fitted = ML.train_classifier(vectors, width, self.getOrDefault(self.kind), self.getOrDefault(self.regParam), self.getOrDefault(self.maxIter))
        if self.getOrDefault(self.kind) == "logistic":
            return model.with_coefficients(*ML.coefficient_table(fitted, dataset.sparkSession))
        model.classifier = fitted
        return model


# ---------------------------------------------------------------- model


class CohortModel(Model, _BundleParams, MLReadable, MLWritable):
    """Maxima, vocabulary and classifier of one run; ``transform`` scores event rows.

    A linear classifier is a coefficient table and an intercept; any other is the fitted
    Spark ML model, saved inside the bundle.
    """

    def __init__(self, vocabulary: DataFrame | None = None, width: int = 0):
        super().__init__()
        self.vocabulary, self.width = vocabulary, width
        self.coefficients: DataFrame | None = None
        self.intercept = 0.0
        self.classifier = None

    def with_coefficients(self, coefficients: DataFrame, intercept: float = 0.0) -> CohortModel:
        """The same bundle with another linear classifier (feature_id, weight)."""
        other = self.copy()
        other.coefficients = coefficients.select(F.col("feature_id").cast("bigint").alias("feature_id"), F.col("weight").cast("double").alias("weight"))
        other.intercept, other.classifier = float(intercept), None
        return other

    def features(self, events: DataFrame, normalised: bool = False) -> DataFrame:
        """(split, patient_id, admit_ms, feature_id, value): known tokens with a visit."""
        ready = events if normalised else self._normalised(events, self._maxima())
        found = FT.index_features(ready.filter(F.col("admit_ms").isNotNull()).drop("label"), self.vocabulary)
        return found.select("split", "patient_id", "admit_ms", "feature_id", "value")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """(split, patient_id, label, logit, score, prediction) of every patient with a known feature.

        The label is the event rows' own, null where they have none.
        """
        events = dataset.select(*COLUMNS)
        pooled = materialize(self._pooled(self.features(events)))
        labels = events.groupBy("split", "patient_id").agg(F.max("label").alias("is_dead"))
        scored = labels.join(pooled.select("split", "patient_id").distinct(), ["split", "patient_id"], "left_semi")
        digits = self.getOrDefault(self.digits)
        if self.classifier is None:
            if self.coefficients is None:
                raise ValueError("the bundle has no classifier")
            return ML.linear_scores(pooled, scored, self.coefficients, self.intercept, None if digits < 0 else digits)
        vectors = scored.withColumnRenamed("is_dead", "label").join(S.patient_vectors(pooled, self.width), ["split", "patient_id"])
        out = ML.predict(self.classifier, vectors)
        return out.select("split", "patient_id", "label", F.lit(None).cast("double").alias("logit"), "score", "prediction")

    def evaluate(self, events: DataFrame, by: list[str] | None = None) -> DataFrame:
        """L2: n, accuracy (%), mean log loss of the patients with a label."""
        scored = self.transform(events).filter(F.col("label").isNotNull())
        return scored.groupBy(*(by or [])).agg(F.count(F.lit(1)).cast("bigint").alias("n"), M.accuracy_expr(), M.log_loss_expr())

    def write(self) -> CohortModelWriter:
        return CohortModelWriter(self)

    @classmethod
    def read(cls) -> CohortModelReader:
        return CohortModelReader(cls)


class CohortModelWriter(MLWriter):
    """``metadata`` (parameters, width, intercept), ``vocabulary``, ``coefficients`` or ``classifier``."""

    def __init__(self, model: CohortModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"width": m.width, "intercept": m.intercept, "linear": m.classifier is None}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        m.vocabulary.write.parquet(f"{path}/vocabulary")
        if m.classifier is not None:
            m.classifier.save(f"{path}/classifier")
        elif m.coefficients is not None:
            m.coefficients.write.parquet(f"{path}/coefficients")
        else:
            raise ValueError("the bundle has no classifier")


class CohortModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CohortModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark, f"{self.cls.__module__}.{self.cls.__name__}")
        model = self.cls(spark.read.parquet(f"{path}/vocabulary"), int(metadata["width"]))
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        model.intercept = float(metadata["intercept"])
        if metadata["linear"]:
            model.coefficients = spark.read.parquet(f"{path}/coefficients")
        else:
            model.classifier = DefaultParamsReader.loadParamsInstance(f"{path}/classifier", spark)
        return model


__all__ = ["CohortEstimator", "CohortModel", "event_rows", "lab_maxima", "new_event_rows"]
