"""Metrics fixture (FIXTURES.md 5) and metric properties."""

import math

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import metrics as M

SCORES = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.4), (0, 0.4), (0, 0.1)]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(i, lab, s) for i, (lab, s) in enumerate(SCORES)], "id long, label int, score double")
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def test_accuracy(scored):
    r = M.accuracy(scored).first()
    assert r.n == 6 and abs(r.accuracy - 200 / 3) < 1e-9


def test_confusion(scored):
    cm = {(r.label, r.prediction): (r.n, r.rate) for r in M.confusion_matrix(scored, normalize=True).collect()}
    assert {k: v[0] for k, v in cm.items()} == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    assert abs(cm[(0, 0)][1] - 2 / 3) < 1e-12 and abs(cm[(1, 0)][1] - 1 / 3) < 1e-12


def test_confusion_missing_class_is_null(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "label int, prediction int")
    cm = {(r.label, r.prediction): (r.n, r.rate) for r in M.confusion_matrix(df, normalize=True).collect()}
    assert cm[(1, 0)] == (0, None) and cm[(1, 1)] == (0, None)


def test_roc_points(scored):
    pts = sorted((r.fpr, r.tpr) for r in M.roc_curve(scored).collect())
    want = [(0, 0), (0, 1 / 3), (1 / 3, 2 / 3), (2 / 3, 1), (1, 1)]
    assert len(pts) == len(want)
    for (a, b), (c, d) in zip(pts, want):
        assert abs(a - c) < 1e-12 and abs(b - d) < 1e-12


def test_auc_and_evaluator(spark, scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    auc = M.roc_auc(scored).first().auc
    assert abs(auc - 7 / 9) < 1e-12
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC")
    assert abs(ev.evaluate(scored.withColumn("label", F.col("label").cast("double"))) - auc) < 1e-9


def test_auc_random_matches_evaluator_and_flip(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(3000).select(
        (F.hash("id") % 2 == 0).cast("int").alias("label"),
        F.round(F.abs(F.hash(F.col("id") * 7)) % 1000 / 1000.0, 2).alias("score"),
    )
    auc = M.roc_auc(df).first().auc
    flipped = M.roc_auc(df.withColumn("score", -F.col("score"))).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert abs(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))) - auc) < 1e-9
    assert abs(auc + flipped - 1.0) < 1e-9


def test_weighted_mean(spark):
    df = spark.createDataFrame([(2.0, 64), (1.0, 16)], "value double, n long")
    assert abs(M.weighted_mean(df).first().mean - 1.8) < 1e-12


def test_best_epoch(spark):
    df = spark.createDataFrame([(0, 70.0), (1, 80.0), (2, 80.0)], "epoch int, accuracy double")
    assert [r.epoch for r in M.best_epoch(df).collect()] == [1]
    none = spark.createDataFrame([(0, 0.0), (1, 0.0)], "epoch int, accuracy double")
    assert M.best_epoch(none).count() == 0


def test_log_loss_forms(spark):
    df = spark.createDataFrame([(1, 0.8, [0.0, math.log(4.0)]), (0, 0.2, [0.0, math.log(0.25)])], "label int, score double, logits array<double>")
    a = M.log_loss(df).first().log_loss
    b = M.log_loss_from_logits(df).first().log_loss
    assert abs(a + math.log(0.8)) < 1e-12 and abs(a - b) < 1e-12


def test_argmax_and_finite(spark):
    from cohortflow.functions import argmax, assert_finite

    df = spark.createDataFrame([([0.2, 0.8],), ([0.5, 0.5],)], "a array<double>")
    assert [r.p for r in df.select(argmax("a").alias("p")).collect()] == [1, 0]
    bad = spark.createDataFrame([(float("nan"),)], "loss double")
    with pytest.raises(Exception):
        assert_finite(bad, "loss").collect()


def test_roc_drop_intermediate(scored):
    pts = sorted((r.fpr, r.tpr) for r in M.roc_curve(scored, drop_intermediate=True).collect())
    want = [(0, 0), (0, 1 / 3), (2 / 3, 1), (1, 1)]
    assert len(pts) == len(want)
    for (a, b), (c, d) in zip(pts, want):
        assert abs(a - c) < 1e-12 and abs(b - d) < 1e-12


def test_roc_drop_intermediate_matches_rule(spark):
    import random

    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 15) / 16.0) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    # Reference rule on the distinct-score points, in plain Python.
    scores = sorted({s for _, s in rows}, reverse=True)
    fps, tps = [], []
    for t in scores:
        tps.append(sum(1 for l, s in rows if s >= t and l == 1))
        fps.append(sum(1 for l, s in rows if s >= t and l == 0))
    keep = [0] + [i for i in range(1, len(scores) - 1)
                  if (fps[i + 1] - 2 * fps[i] + fps[i - 1]) or (tps[i + 1] - 2 * tps[i] + tps[i - 1])] + [len(scores) - 1]
    want = sorted(scores[i] for i in keep)
    got = sorted(r.threshold for r in M.roc_curve(df, drop_intermediate=True).collect() if r.threshold != float("inf"))
    assert got == want
