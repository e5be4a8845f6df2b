"""Evaluation metrics as DataFrames.

Every metric is an aggregation (optionally per ``by`` columns, e.g. split).
ROC points and AUC aggregate by distinct score first and then use a
distributed running sum, so no metric funnels the rows through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.ordering import grouped_prefix_sums, grouped_running
from cohortflow.session import materialize

EPS = 1e-15


def weighted_mean(df: DataFrame, value: str = "value", n: str = "n", by: list[str] | None = None) -> DataFrame:
    """Count-weighted mean of per-batch values: sum(v*n) / sum(n)."""
    by = by or []
    return df.groupBy(*by).agg(
        (F.sum(F.col(value) * F.col(n)) / F.sum(n)).alias("mean"),
        F.sum(n).cast("bigint").alias("count"),
    )


def accuracy_expr(label: str = "label", prediction: str = "prediction"):
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return (F.avg(hit) * 100.0).alias("accuracy")


def log_loss_expr(label: str = "label", score: str = "score"):
    p = F.least(F.greatest(F.col(score), F.lit(EPS)), F.lit(1.0 - EPS))
    ce = -(F.col(label) * F.ln(p) + (F.lit(1) - F.col(label)) * F.ln(F.lit(1.0) - p))
    return F.avg(ce).alias("log_loss")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """A10: percent of rows with prediction == label."""
    by = by or []
    return pred.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("n"), accuracy_expr(label, prediction))


def log_loss(pred: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None) -> DataFrame:
    """Mean binary cross-entropy of the positive-class probability."""
    by = by or []
    return pred.groupBy(*by).agg(log_loss_expr(label, score))


def log_loss_from_logits(pred: DataFrame, label: str = "label", logits: str = "logits", by: list[str] | None = None) -> DataFrame:
    """A11, stable form over class logits: logsumexp(logits) - logits[label]."""
    by = by or []
    z = F.col(logits)
    m = F.array_max(z)
    lse = m + F.ln(F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))
    ce = lse - F.element_at(z, F.col(label).cast("int") + 1)
    return pred.groupBy(*by).agg(F.avg(ce).alias("log_loss"))


def confusion_matrix(
    pred: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: list[str] | None = None,
    normalize: bool = False,
) -> DataFrame:
    """Fixed 2x2 matrix (label, prediction, n[, rate]) for classes {0,1}.

    One conditional aggregation (no join, no pivot job) and an unpivot; the
    normalised rate is n / row total, NULL for a label that never occurs.
    """
    by = by or []
    cells = []
    for t in (0, 1):
        for p in (0, 1):
            hit = (F.col(label) == t) & (F.col(prediction) == p)
            cells.append(F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias(f"c{t}{p}"))
    wide = pred.groupBy(*by).agg(*cells)
    long = wide.select(
        *by,
        F.expr("stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) as (label, prediction, n)"),
    ).select(*by, F.col("label").cast("int"), F.col("prediction").cast("int"), F.col("n").cast("bigint"))
    if not normalize:
        return long
    from pyspark.sql import Window

    row_total = F.sum("n").over(Window.partitionBy(*by, "label"))
    return long.withColumn("rate", F.try_divide(F.col("n").cast("double"), row_total.cast("double")))


def _grouping(df: DataFrame, by: list[str] | None):
    """Metrics over the whole input use one constant group key."""
    if by:
        return df, list(by), []
    return df.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def _score_groups(scores: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    return scores.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((F.lit(1) - F.col(label)).cast("bigint")).alias("neg"),
    )


def roc_curve(
    scores: DataFrame,
    label: str = "label",
    score: str = "score",
    by: list[str] | None = None,
    drop_intermediate: bool = False,
) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the (0, 0) start.

    Thresholds are the distinct scores, descending; the start point has
    threshold +infinity.  With ``drop_intermediate`` a point is kept only
    where the curve turns (second difference of the false or true positive
    counts is not zero), and at both ends, as plotted ROC curves usually are.
    Neighbours are found by equi-joins on a distributed point index.
    """
    scores, by, extra = _grouping(scores, by)
    g = _score_groups(scores, label, score, by).withColumn("_one", F.lit(1).cast("bigint"))
    c, totals = grouped_running(g, by, [F.col(score).desc()], ["pos", "neg", "_one"])
    # One row per group (split): a bounded side.
    totals = totals.select(*by, F.col("pos_total").alias("P"), F.col("neg_total").alias("N"), F.col("_one_total").alias("K"))
    if drop_intermediate:
        c = materialize(c)  # read three times: itself and both neighbours
    pts = c.join(F.broadcast(totals), by)
    if drop_intermediate:
        nb = c.select(*by, "_one_cum", "pos_cum", "neg_cum")
        prev = nb.select(*by, (F.col("_one_cum") + 1).alias("_one_cum"), F.col("pos_cum").alias("_pp"), F.col("neg_cum").alias("_pn"))
        nxt = nb.select(*by, (F.col("_one_cum") - 1).alias("_one_cum"), F.col("pos_cum").alias("_np"), F.col("neg_cum").alias("_nn"))
        pts = pts.join(prev, by + ["_one_cum"], "left").join(nxt, by + ["_one_cum"], "left")
        turn = ((F.col("_nn") - 2 * F.col("neg_cum") + F.col("_pn")) != 0) | ((F.col("_np") - 2 * F.col("pos_cum") + F.col("_pp")) != 0)
        ends = (F.col("_one_cum") == 1) | (F.col("_one_cum") == F.col("K"))
        pts = pts.filter(ends | turn)
    pts = pts.select(
        *by,
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("neg_cum").cast("double"), F.col("N").cast("double")).alias("fpr"),
        F.try_divide(F.col("pos_cum").cast("double"), F.col("P").cast("double")).alias("tpr"),
    )
    start = totals.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts).drop(*extra)


def roc_auc(scores: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve with ties counted as one half.

    AUC = sum over distinct scores of neg * (positives scored higher + pos/2),
    divided by P*N.  NULL when a class is missing.
    """
    scores, by, extra = _grouping(scores, by)
    g = _score_groups(scores, label, score, by)
    c = grouped_prefix_sums(g, by, [F.col(score).desc()], ["pos"])
    above = F.col("pos_cum") - F.col("pos")
    area = c.groupBy(*by).agg(
        F.sum(F.col("neg").cast("double") * (above.cast("double") + F.col("pos").cast("double") / 2.0)).alias("_a"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    )
    return area.select(
        *by,
        F.try_divide(F.col("_a"), (F.col("P") * F.col("N")).cast("double")).alias("auc"),
        F.col("P").cast("bigint").alias("n_pos"),
        F.col("N").cast("bigint").alias("n_neg"),
    ).drop(*extra)


def best_epoch(metrics: DataFrame, accuracy_col: str = "accuracy", epoch: str = "epoch") -> DataFrame:
    """The first epoch with the highest validation accuracy, if above 0.

    A top-1 report: the limit is the feature.
    """
    return metrics.filter(F.col(accuracy_col) > 0).orderBy(F.desc(accuracy_col), F.asc(epoch)).limit(1)


# ---------------------------------------------------------------- bounded ROC

#: Size of the quantile sketches; a rank is off by less than 3 / size of the rows (99 %).
SKETCH_SIZE = 4096


def roc_sketches(pred: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None, size: int = SKETCH_SIZE) -> DataFrame:
    """(by, label, n, sketch): a mergeable quantile sketch of the scores of each class.

    A few tens of kilobytes per group and class, however many distinct scores there are;
    partial sketches are merged after the shuffle, and sketches of several days or shards
    with ``merge_roc_sketches``.  Null scores are left out.
    """
    rows = pred.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(score).cast("double"), F.lit(size))
    return rows.groupBy(*(by or []), F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).cast("bigint").alias("n"), sketch.alias("sketch"))


def merge_roc_sketches(sketches: DataFrame, by: list[str] | None = None, size: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of several runs as one per group and class."""
    return sketches.groupBy(*(by or []), "label").agg(F.sum("n").cast("bigint").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def roc_from_sketches(sketches: DataFrame, by: list[str] | None = None, points: int = 200, grid: int = 1000) -> DataFrame:
    """W3 in bounded form: (by, threshold, fpr, tpr) at thresholds taken from both classes.

    Every class is read out as ``grid`` + 1 quantiles; a rate is the share of a class's
    quantiles at or above the threshold, so it is within the sketch's rank error and
    1 / grid of ``roc_curve``'s at the same threshold.  At most ``2 (points + 1) + 1`` rows a
    group, from (inf, 0, 0) down to the smallest score.  A class without rows has null rates.
    """
    by = by or []
    ranks = lambda n: F.array(*[F.lit(i / n) for i in range(n + 1)])
    read = sketches.select(*by, "label", F.kll_sketch_get_quantile_double("sketch", ranks(points)).alias("cuts"), F.kll_sketch_get_quantile_double("sketch", ranks(grid)).alias("grid"))
    pick = lambda k, c: F.max(F.when(F.col("label") == k, F.col(c)))
    both = read.groupBy(*by).agg(*[pick(k, c).alias(f"{c}{k}") for k in (0, 1) for c in ("cuts", "grid")])
    none = F.array().cast("array<double>")
    thresholds = F.array_union(F.array(F.lit(float("inf"))), F.array_union(F.coalesce("cuts0", none), F.coalesce("cuts1", none)))
    both = both.filter(F.coalesce("grid0", "grid1").isNotNull())  # no scores, no curve
    each = both.select(*by, "grid0", "grid1", F.explode(thresholds).alias("threshold"))
    rate = lambda g: F.size(F.filter(g, lambda q: q >= F.col("threshold"))) / F.lit(float(grid + 1))
    return each.select(*by, "threshold", F.when(F.col("grid0").isNotNull(), rate("grid0")).alias("fpr"), F.when(F.col("grid1").isNotNull(), rate("grid1")).alias("tpr"))


def auc_from_roc(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A14 over a bounded curve: the trapezoids between its points (a window per group)."""
    from pyspark.sql import Window

    by = by or []
    w = Window.partitionBy(*by).orderBy(F.desc("threshold")) if by else Window.orderBy(F.desc("threshold"))
    steps = points.withColumn("_dx", F.col("fpr") - F.lag("fpr").over(w)).withColumn("_y", (F.col("tpr") + F.lag("tpr").over(w)) / 2.0)
    return steps.groupBy(*by).agg(F.sum(F.col("_dx") * F.col("_y")).alias("auc"))
