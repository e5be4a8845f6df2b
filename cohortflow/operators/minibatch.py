"""Training by mini-batches and epochs (L1 + W4), as relational algebra.

The model is linear over pooled cells.  A step joins one batch's cells to the coefficient
table, sums the logits per patient, joins the residuals back to the cells and sums the
gradient per feature; the coefficient table with its two Adam moments is the state.  Each
step writes the new state in the shared folder and frees the one before, so lineage stays
one step long and a lost executor re-reads a table.

The cells' stage table lies in a bounded number of folders, each of consecutive batches and
sorted by batch: a step opens its batch's folder and, by the files' statistics, reads the
pages of its batch only.  The state has one row per vocabulary entry, so Spark picks its joins
by size.  The number of steps is patients / batch size per epoch: take batches that fill
the cluster (millions of patients), not 64, where there are many patients.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.scores import assert_finite, sigmoid
from cohortflow.operators import metrics as M
from cohortflow.operators import sequences as S
from cohortflow.session import materialize, materialize_at, release_tables

# --- fixed training settings of the original (optimiser, rate, decay, batch) ----------
RATE = 0.007
DECAY = 4e-4
BETA1 = 0.9
BETA2 = 0.999
EPSILON = 1e-8
BATCH_SIZE = 64
# ---------------------------------------------------------------------------

#: Most folders of a table dealt by batch, and the least number of parts of each.
FOLDERS = 64
PARTS = 8
#: The intercept is the weight of a feature that every patient has with value 1.
INTERCEPT_ID = -1


@dataclass
class Trained:
    """State and curve of a run: ``states[e]`` is (feature_id, weight, m, v) after epoch e."""

    states: list[DataFrame] = field(default_factory=list)
    curve: DataFrame | None = None
    steps: int = 0

    def coefficients(self, epoch: int = -1) -> DataFrame:
        return self.states[epoch].filter(F.col("feature_id") != INTERCEPT_ID).select("feature_id", "weight")

    def intercept(self, epoch: int = -1) -> float:
        row = self.states[epoch].filter(F.col("feature_id") == INTERCEPT_ID).select("weight").first()
        return float(row[0]) if row else 0.0


def start_state(coefficients: DataFrame, intercept: float = 0.0) -> DataFrame:
    """(feature_id, weight, m, v) from a coefficient table: no moment yet."""
    zero = F.lit(0.0)
    table = coefficients.select(F.col("feature_id").cast("bigint").alias("feature_id"), F.col("weight").cast("double").alias("weight"))
    own = table.sparkSession.range(1).select(F.lit(INTERCEPT_ID).cast("bigint").alias("feature_id"), F.lit(float(intercept)).alias("weight"))
    return table.unionByName(own).withColumns({"m": zero, "v": zero})


def batch_cells(pooled: DataFrame, labels: DataFrame, size: int = BATCH_SIZE, seed: int | None = 0) -> tuple[DataFrame, DataFrame]:
    """Patients with batch and batch size, and their cells.

    (patient_id, label, batch_id, n) and (patient_id, feature_id, value, batch_id); the
    intercept is a cell of every patient, so a patient without cells has a row too.
    """
    one = labels.select("patient_id", F.col("is_dead").cast("int").alias("label"))
    batched = materialize(S.assign_batches(one, size, seed).drop("position"))
    sizes = batched.groupBy("batch_id").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    patients = batched.join(sizes, "batch_id").select("patient_id", "label", "batch_id", "n")
    cells = pooled.select("patient_id", F.col("feature_id").cast("bigint").alias("feature_id"), "value")
    # One narrow row per patient: hashed after the shuffle, so that the cells need no sort.
    cells = cells.join(batched.select("patient_id", "batch_id").hint("shuffle_hash"), "patient_id")
    own = batched.select("patient_id", F.lit(INTERCEPT_ID).cast("bigint").alias("feature_id"), F.lit(1.0).alias("value"), "batch_id")
    return patients, cells.unionByName(own)


def _by_batch(df: DataFrame, per: int) -> tuple[DataFrame, str]:
    """``df`` written by batch, ``per`` consecutive batches to a folder (``batch_group``), sorted by batch.

    The number of files does not grow with the number of batches.  A folder's rows are
    spread over several files, so no task holds a whole batch, however large.
    """
    spread = max(PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // FOLDERS)
    grouped = df.withColumn("batch_group", F.floor(F.col("batch_id") / F.lit(per)).cast("bigint"))
    dealt = grouped.repartition("batch_group", F.pmod(F.xxhash64("patient_id"), F.lit(spread)))
    return materialize_at(dealt.sortWithinPartitions("batch_group", "batch_id"), "batch_group")


def _of_batch(df: DataFrame, batch: int, per: int) -> DataFrame:
    """The rows of one batch of a table of ``_by_batch``."""
    return df.filter((F.col("batch_group") == batch // per) & (F.col("batch_id") == batch)).drop("batch_group", "batch_id")


def score_batch(state: DataFrame, patients: DataFrame, cells: DataFrame) -> DataFrame:
    """Forward pass: (patient_id, label, n, score, prediction); a score that is not finite fails."""
    weighted = cells.join(state.select("feature_id", "weight"), "feature_id")
    logits = weighted.groupBy("patient_id").agg(F.sum(F.col("value") * F.col("weight")).alias("logit"))
    scored = assert_finite(patients.join(logits, "patient_id"), "logit").withColumn("score", sigmoid("logit"))
    return scored.select("patient_id", "label", "n", "score", (F.col("score") > F.lit(0.5)).cast("int").alias("prediction"))


def next_state(state: DataFrame, scored: DataFrame, cells: DataFrame, step: int, rate: float = RATE, decay: float = DECAY) -> DataFrame:
    """Backward pass of step ``step`` (from 1): the state after one Adam update.

    The loss is the batch's mean cross entropy; ``decay`` adds its share of every weight
    to the gradient, the intercept's included.
    """
    residual = scored.select("patient_id", ((F.col("score") - F.col("label")) / F.col("n")).alias("r"))
    slope = cells.join(residual, "patient_id").groupBy("feature_id").agg(F.sum(F.col("r") * F.col("value")).alias("g"))
    both = state.join(slope, "feature_id", "left")
    g = F.coalesce("g", F.lit(0.0)) + F.lit(decay) * F.col("weight")
    both = both.select("feature_id", "weight", "m", "v", g.alias("g"))
    m = F.lit(BETA1) * F.col("m") + F.lit(1.0 - BETA1) * F.col("g")
    v = F.lit(BETA2) * F.col("v") + F.lit(1.0 - BETA2) * F.col("g") * F.col("g")
    both = both.select("feature_id", "weight", m.alias("m"), v.alias("v"))
    move = F.lit(rate) * (F.col("m") / F.lit(1.0 - BETA1**step)) / (F.sqrt(F.col("v") / F.lit(1.0 - BETA2**step)) + F.lit(EPSILON))
    return both.select("feature_id", (F.col("weight") - move).alias("weight"), "m", "v")


def train_minibatch(
    pooled: DataFrame,
    labels: DataFrame,
    start: DataFrame,
    epochs: int = 1,
    size: int = BATCH_SIZE,
    seed: int = 0,
    max_steps: int | None = None,
    rate: float = RATE,
    decay: float = DECAY,
) -> Trained:
    """L1 + W4 + A16: train on pooled cells by batches, from ``start`` (see ``start_state``).

    ``pooled``: (patient_id, feature_id, value) and ``labels``: (patient_id, is_dead) of the
    training split; ``start`` needs a row for every feature that shall learn (cells of
    other features add nothing).  Every epoch deals the patients anew in a seeded order
    (seed + epoch).  The curve is (epoch, n, loss, accuracy): the means over the epoch's
    batches, weighted by their size, of the forward passes before each update.
    ``max_steps`` ends the run early; the epoch under way then counts what it saw.

    The driver loops over steps and holds the list of batch numbers; rows stay in Spark.
    No patients: no step, the state is the start.
    """
    out = Trained()
    state, state_path = materialize_at(start)
    for epoch in range(epochs):
        dealt = batch_cells(pooled, labels, size, seed + epoch)
        last = dealt[0].agg(F.max("batch_id")).first()[0]
        per = 1 if last is None else -(-(last + 1) // FOLDERS)
        (patients, p_path), (cells, c_path) = (_by_batch(t, per) for t in dealt)
        batches = [r[0] for r in patients.select("batch_id").distinct().orderBy("batch_id").collect()]
        seen, seen_paths, epoch_start = [], [], state_path
        for batch in batches:
            if max_steps is not None and out.steps >= max_steps:
                break
            out.steps += 1
            mine = _of_batch(cells, batch, per)
            scored, path = materialize_at(score_batch(state, _of_batch(patients, batch, per), mine))
            seen.append(scored)
            seen_paths.append(path)
            before = state_path
            state, state_path = materialize_at(next_state(state, scored, mine, out.steps, rate, decay))
            if before != epoch_start:  # the states between epochs are the run's result
                release_tables([before])
        if seen:
            row = _epoch_row(seen, epoch)
            out.curve = row if out.curve is None else out.curve.unionByName(row)
        release_tables([*seen_paths, p_path, c_path])
        out.states.append(state)
        if max_steps is not None and out.steps >= max_steps:
            break
    return out


def _epoch_row(seen: list[DataFrame], epoch: int) -> DataFrame:
    every = seen[0]
    for other in seen[1:]:
        every = every.unionByName(other)
    # The mean over all rows is the batch means weighted by batch size.
    row = every.agg(F.count(F.lit(1)).cast("bigint").alias("n"), M.log_loss_expr().alias("loss"), M.accuracy_expr())
    return materialize(assert_finite(row, "loss").select(F.lit(epoch).cast("int").alias("epoch"), "n", "loss", "accuracy"))
