"""Classifier on Spark ML (L1-L4).

The original trains a recurrent network on one machine.  Here the model is a
Spark ML estimator over patient-level sparse vectors (``pool_sequences`` +
``patient_vectors``), trained with distributed aggregation; the data path,
metrics and scoring interface are the equivalents, the model itself is not.

A logistic model holds one weight per vocabulary entry on the driver, the layered
perceptron 64 per entry (its first layer): both are bounded by the vocabulary.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.scores import argmax, assert_finite, sigmoid, sigmoid_score
from cohortflow.operators import metrics as M
from cohortflow.session import Lazy, checkpoint_dir, track_table

# --- fixed training settings of the original (weight decay, seed) ----------
L2_DECAY = 4e-4
SEED = 0
# ---------------------------------------------------------------------------


def train_classifier(
    vectors: DataFrame,
    width: int | None = None,
    kind: str = "logistic",
    reg: float = L2_DECAY,
    max_iter: int = 100,
    seed: int = SEED,
    label: str = "label",
    features: str = "features",
    start=None,
):
    """L1: fit a binary classifier; ``kind`` is ``logistic`` or ``mlp``.

    ``start``: weights of a fitted perceptron to go on from, instead of the seeded ones.
    """
    data = vectors.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    if kind == "logistic":
        from pyspark.ml.classification import LogisticRegression

        est = LogisticRegression(regParam=reg, elasticNetParam=0.0, maxIter=max_iter, tol=1e-9, standardization=False)
    elif kind == "mlp":
        from pyspark.ml.classification import MultilayerPerceptronClassifier

        if width is None:
            raise ValueError("the mlp needs the input width")
        est = MultilayerPerceptronClassifier(layers=[width, 64, 16, 2], maxIter=max_iter, seed=seed)
        if start is not None:
            est = est.setInitialWeights(start)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return est.fit(data)


@dataclass
class Epochs:
    """Models of all epochs (saved) and their curve."""

    paths: list[str]
    curve: DataFrame


def train_epochs(vectors: DataFrame, width: int, kind: str = "logistic", epochs=(5, 10, 20, 50), folder: str | None = None) -> Epochs:
    """L1 + A16: one fit per iteration budget on the training split, each saved.

    The perceptron goes on from the epoch before: its budgets are the iterations up to
    each epoch, and an epoch runs what its budget adds.  The logistic fit has no such start;
    each budget starts anew (``minibatch.train_minibatch`` has true epochs for it).

    The curve is (epoch, phase, n, loss, accuracy) for training and validation; a
    loss that is not finite fails the job.  The driver loop is over the given
    epochs; models and curve rows are as many.
    """
    from cohortflow.sources.sinks import save_model

    spark = vectors.sparkSession
    base = folder or f"{checkpoint_dir(spark).rstrip('/')}/cohortflow-tables/models_{uuid.uuid4().hex}"
    if folder is None:
        track_table(spark, base)
    phases = vectors.filter(F.col("split").isin("train", "valid"))
    paths, curve, start, done = [], None, None, 0
    for epoch, budget in enumerate(epochs):
        model = train_classifier(vectors.filter(F.col("split") == "train"), width, kind, max_iter=max(1, budget - done), start=start)
        if kind == "mlp":
            start, done = model.weights, budget
        paths.append(f"{base}/epoch_{epoch}")
        save_model(model, paths[-1])
        rows = phase_metrics(predict(model, phases).withColumnRenamed("split", "phase"), epoch)
        curve = rows if curve is None else curve.unionByName(rows)
    return Epochs(paths, curve)


def phase_metrics(predictions: DataFrame, epoch: int) -> DataFrame:
    """(epoch, phase, n, loss, accuracy) of predictions with a ``phase``."""
    rows = predictions.groupBy("phase").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), M.log_loss_expr().alias("loss"), M.accuracy_expr()
    )
    return assert_finite(rows, "loss").select(F.lit(epoch).cast("int").alias("epoch"), "phase", "n", "loss", "accuracy")


def load_epoch(fitted: Epochs, epoch: int):
    """The saved model of one epoch."""
    from cohortflow.sources.sinks import load_model

    return load_model(fitted.paths[epoch])


def predict(model, vectors: DataFrame, keys: list[str] | None = None, label: str = "label") -> DataFrame:
    """L3: (keys, label, score, prediction, logits); score = sigmoid of the positive logit
    for a linear model, P(class 1) otherwise."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.functions import vector_to_array

    keys = keys if keys is not None else [c for c in ("split", "patient_id") if c in vectors.columns]
    out = model.transform(vectors.withColumnRenamed(label, "label") if label != "label" else vectors)
    prob = vector_to_array("probability")
    score = sigmoid_score("rawPrediction") if isinstance(model, LogisticRegressionModel) else F.element_at(prob, 2)
    return out.select(
        *keys,
        F.col("label").cast("int").alias("label"),
        score.alias("score"),
        argmax(prob).alias("prediction"),
        vector_to_array("rawPrediction").alias("logits"),
    )


def linear_scores(pooled: DataFrame, labels: DataFrame, coefficients: DataFrame, intercept: float = 0.0, digits: int | None = None) -> DataFrame:
    """L3 as relational algebra: pooled cells x coefficient table, per labelled patient.

    Cells without a coefficient add 0 and a patient without cells scores the
    intercept.  ``digits`` rounds the logit (half up) so that the result does not
    depend on the order of the sum.
    """
    weighted = pooled.join(coefficients.select("feature_id", "weight"), "feature_id", "inner")
    sums = weighted.groupBy("split", "patient_id").agg(F.sum(F.col("value") * F.col("weight")).alias("_sum"))
    logit = F.coalesce("_sum", F.lit(0.0)) + F.lit(float(intercept))
    if digits is not None:
        scale = F.lit(float(10**digits))
        logit = F.floor(logit * scale + F.lit(0.5)) / scale
    lab = labels.select("split", "patient_id", F.col("is_dead").cast("int").alias("label"))
    scored = lab.join(sums, ["split", "patient_id"], "left").select("split", "patient_id", "label", logit.alias("logit"))
    scored = assert_finite(scored, "logit").withColumn("score", sigmoid("logit"))
    return scored.withColumn("prediction", argmax(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))


def coefficient_table(model, spark: SparkSession) -> tuple[DataFrame, float]:
    """(feature_id, weight) of a fitted logistic model, and its intercept."""
    weights = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray()) if w]
    return spark.createDataFrame(weights, "feature_id bigint, weight double"), float(model.intercept)


def gradient_norm(pooled: DataFrame, scored: DataFrame, coefficients: DataFrame, reg: float = L2_DECAY) -> float:
    """Norm of the logistic objective's gradient for a linear model (near 0 at its optimum).

    Per feature: the mean of residual times value over the training patients,
    plus the penalty's part.  ``pooled`` and ``scored`` hold the training split.
    """
    n = scored.count()
    r = scored.select("split", "patient_id", (F.col("score") - F.col("label")).alias("r")).hint("shuffle_hash")
    sums = pooled.join(r, ["split", "patient_id"]).groupBy("feature_id").agg((F.sum(F.col("r") * F.col("value")) / n).alias("g"))
    part = F.coalesce("g", F.lit(0.0)) + F.lit(reg) * F.coalesce("weight", F.lit(0.0))
    g = sums.join(coefficients, "feature_id", "full").select(part.alias("g"))
    return float(g.agg(F.sqrt(F.sum(F.col("g") * F.col("g")))).first()[0] or 0.0)


def evaluate(model, vectors: DataFrame, by: list[str] | None = None) -> DataFrame:
    """L2: n, accuracy (%), mean log loss per group; a loss that is not finite fails."""
    pred = predict(model, vectors)
    rows = pred.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), M.accuracy_expr(), M.log_loss_expr()
    )
    return rows if by is None else assert_finite(rows, "log_loss")


def learning_curve(model, spark) -> DataFrame:
    """Per-iteration training objective (bounded by ``maxIter``)."""
    summary = getattr(model, "summary", None)
    history = list(summary.objectiveHistory) if summary is not None and hasattr(summary, "objectiveHistory") else []
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(history)], "epoch int, loss double")


class Report(Lazy):
    """Report tables built on first access (ROC and AUC run their own jobs,
    so a caller that only reads predictions does not pay for them)."""


def report(model, vectors: DataFrame, by: list[str] | None = None, curve: DataFrame | None = None) -> Report:
    """L4: hold-out report tables: ROC points, AUC, confusion matrices, accuracy, learning curve."""
    pred = predict(model, vectors)
    return report_tables(pred, by, curve if curve is not None else learning_curve(model, vectors.sparkSession))


def report_tables(pred: DataFrame, by: list[str] | None = None, curve: DataFrame | None = None) -> Report:
    """L4 over any predictions (label, score, prediction)."""
    tables = {
        "predictions": lambda: pred,
        "roc": lambda: M.roc_curve(pred, by=by),
        "auc": lambda: M.roc_auc(pred, by=by),
        "confusion": lambda: M.confusion_matrix(pred, by=by, normalize=True),
        "accuracy": lambda: M.accuracy(pred, by=by),
        "log_loss": lambda: M.log_loss(pred, by=by),
    }
    if curve is not None:
        tables["learning_curve"] = lambda: curve
    return Report(tables)
