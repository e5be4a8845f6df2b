"""Registered queries: one per operator group of the inventory.

Every query reads the test tables through the role views and runs the
library's operators over the whole tables.  Doubles that come out of sums of
many terms are rounded to 9 decimals so that an order-insensitive comparison
with another engine is stable; scores are rounded to 6 decimals before use.
"""

from __future__ import annotations

import math
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.scores import argmax, sigmoid
from cohortflow.functions.text import norm_token
from cohortflow.operators import clean, cohort as C, features as FT, metrics as M, minibatch as MB, model as ML, sequences as S, vocab as V
from cohortflow.plans import composite as P
from cohortflow.plans import roles as R
from cohortflow.schemas import RAW_COLUMNS
from cohortflow.session import Lazy, checkpoint_dir, materialize, track_table
from cohortflow.sources import (
    load_csv_as_table,
    load_model,
    load_records,
    load_records_sql,
    ragged_rejects,
    read_by_patient,
    read_features,
    read_labels,
    read_prepared,
    read_sequences,
    scan_checked,
    scan_raw,
    write_by_patient,
    write_features,
    write_prepared,
    write_sequences,
    write_split_files,
)
from cohortflow.sources.csv import RAGGED

BATCH_SIZE = 64
SHUFFLE_SEED = 0
INTERCEPT = -0.25  # of the fixed linear model
OFF_TIES = 1e-9  # added before rounding where sums come near to a tie


def _r(c, n: int = 9) -> Column:
    """Round half up at ``n`` decimals with plain double arithmetic, the same
    formula the oracle SQL uses, so both engines round a tie the same way."""
    x = F.col(c) if isinstance(c, str) else c
    scale = float(10**n)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, freed with the stage tables."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/cohortflow-tables/{name}_{uuid.uuid4().hex}"
    track_table(spark, path)
    return path


def _fixed_coefficients(vocabulary: DataFrame, scale: float = 1.0) -> DataFrame:
    weight = ((F.col("feature_id") * 37) % 101 - 50) / F.lit(1000.0) * F.lit(scale)
    return vocabulary.select("feature_id", weight.alias("weight"))


def _patient_counts(features: DataFrame) -> DataFrame:
    """(split, patient_id, n_visits, n_distinct): visits and distinct features per patient."""
    k = ["split", "patient_id"]
    # Counted apart: two distinct counts in one grouping double every row first.
    n_visits = features.select(*k, "admit_ms").distinct().groupBy(*k).agg(F.count("admit_ms").alias("n_visits"))
    n_distinct = features.select(*k, "feature_id").distinct().groupBy(*k).agg(F.count("feature_id").alias("n_distinct"))
    return n_visits.join(n_distinct, k)


class Stages:
    """Lazily built pipeline stages over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> Lazy:
        # The role views stand in for the raw files: the line-item join that
        # three of them share is written once, when the first is read.
        return R.role_tables(self.spark, self.sf_dir, hold=materialize)

    @cached_property
    def prep(self) -> P.Prepared:
        return P.prepare(self.raw)

    @cached_property
    def recs(self) -> Lazy:
        return P.records(self.prep.tables)

    def train(self, table: str) -> DataFrame:
        return self.recs[table].filter(F.col("split") == "train")

    @cached_property
    def vocab(self) -> P.Vocabulary:
        return P.build_vocabulary(self.recs)

    @cached_property
    def ds(self) -> P.Dataset:
        return P.build_dataset(self.recs, self.vocab)

    @cached_property
    def matrix(self) -> DataFrame:
        return S.visit_matrix(self.ds.features)

    @cached_property
    def scores(self) -> DataFrame:
        """Deterministic rule score per labelled patient (stands in for a model)."""
        per = _patient_counts(self.ds.features)
        logit = F.lit(0.375) * F.col("n_visits") + F.lit(0.03125) * F.col("n_distinct") - F.lit(2.0)
        score = _r(sigmoid(logit), 6)
        lab = self.ds.labels.select("split", "patient_id", F.col("is_dead").cast("int").alias("label"))
        return (
            per.join(lab, ["split", "patient_id"])
            .select("split", "patient_id", "label", score.alias("score"))
            .withColumn("prediction", argmax(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))
        )

    def coefficients(self, scale: float = 1.0) -> DataFrame:
        """A fixed coefficient table over the vocabulary."""
        return _fixed_coefficients(self.vocab.table, scale)

    def linear(self, scale: float = 1.0) -> DataFrame:
        """Every labelled patient scored with the fixed coefficients."""
        pooled = S.pool_sequences(self.matrix, "sum")
        return ML.linear_scores(pooled, self.ds.labels, self.coefficients(scale), INTERCEPT, digits=6)


# ------------------------------------------------------------------ C1


def prepared(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Stages(spark, sf_dir).prep.tables[table]

    return q


def cohort_split(spark, sf_dir):
    return Stages(spark, sf_dir).prep.cohort.select("SUBJECT_ID", "split")


def split_summary(spark, sf_dir):
    st = Stages(spark, sf_dir)
    counts = st.prep.cohort.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n_patients"))
    labs = C.restrict_to_cohort(clean.parse_lab_values(st.raw["labevents"]), st.prep.cohort)
    maxima = C.split_max(clean.drop_null_values(labs)).withColumnRenamed("max_value", "lab_max")
    return counts.join(maxima, "split", "left")


def rejects(spark, sf_dir):
    return P.rejects_report(Stages(spark, sf_dir).prep)


def admission_records(spark, sf_dir):
    return Stages(spark, sf_dir).recs["admissions"]


def _write_raw_csv(rows: DataFrame, path: str, ragged: bool) -> None:
    """A raw table as headered CSV, as it is; with ``ragged`` some rows get a field too many."""
    if ragged:
        last = rows.columns[-1]
        # A value with a bare comma makes its row one column too long.
        hit = F.conv(F.substring(F.md5("SUBJECT_ID"), 1, 4), 16, 10).cast("int") % 53 == 0
        rows = rows.withColumn(last, F.when(hit, F.concat(F.coalesce(last, F.lit("")), F.lit(",extra"))).otherwise(F.col(last)))
    out = rows.write.option("header", True).option("quote", "\u0000").option("emptyValue", "")
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def csv_front_door(spark, sf_dir):
    """S1-S4 end to end: all six raw tables written as headered CSV in the
    shared folder with ragged rows among them, registered as views named from their paths (S2,
    S3; ragged rows dropped), and selected with the present-field statement (S4)."""
    raw, folder, parts = Stages(spark, sf_dir).raw, _folder(spark, "raw"), []
    for table, columns in RAW_COLUMNS.items():
        path = f"{folder}/{table}_raw.csv"
        _write_raw_csv(raw[table], path, ragged=True)
        load_csv_as_table(spark, path)
        kept = load_records_sql(spark, f"{table}_raw", columns)
        spark.catalog.dropTempView(f"{table}_raw")  # the plan no longer needs the name
        rest = [F.col(c) for c in columns[1:]]
        parts.append(kept.select(F.lit(table).alias("table_name"), F.col("SUBJECT_ID").alias("subject_id"), F.concat_ws("|", *rest).alias("fields")))
    return _union(parts)


def raw_scan(spark, sf_dir):
    """Every row of the six raw tables, written as CSV files with more columns than the
    engine needs and scanned with the header given."""
    raw, folder, parts = Stages(spark, sf_dir).raw, _folder(spark, "raw"), []
    for table, columns in RAW_COLUMNS.items():
        header = ["ROW_ID", *columns, "NOTE"]
        path = f"{folder}/{table}.csv"
        _write_raw_csv(raw[table].select(F.lit("1").alias("ROW_ID"), *columns, F.lit("n").alias("NOTE")), path, ragged=False)
        rows = scan_raw(spark, path, table, header)
        parts.append(rows.select(F.lit(table).alias("table_name"), F.col("SUBJECT_ID").alias("subject_id"), F.concat_ws("|", *columns[1:]).alias("fields")))
    return _union(parts)


def _checked(spark, sf_dir) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per raw table: the rows written as CSV with ragged ones among them, and their checked scan."""
    raw, folder, out = Stages(spark, sf_dir).raw, _folder(spark, "raw"), {}
    for table, columns in RAW_COLUMNS.items():
        path = f"{folder}/{table}.csv"
        _write_raw_csv(raw[table], path, ragged=True)
        out[table] = raw[table], scan_checked(spark, path, columns)
    return out


def ragged_rows(spark, sf_dir):
    """S2 + C6: every ragged row of the raw files, as a reject with its text."""
    rows = _union([ragged_rejects(found, table) for table, (_, found) in _checked(spark, sf_dir).items()])
    return rows.withColumn("record", F.translate("record", "\u0000", ""))  # the writer's quotes


def ragged_counts(spark, sf_dir):
    """S2 + C6: rows written, kept and rejected per raw table; the last two add up to the first."""
    parts = []
    for table, (written, found) in _checked(spark, sf_dir).items():
        total = written.agg(F.count(F.lit(1)).cast("bigint").alias("written")).withColumn("table_name", F.lit(table))
        both = found.agg(F.count(F.when(F.col(RAGGED).isNull(), 1)).alias("kept"), F.count(RAGGED).alias("rejected")).withColumn("table_name", F.lit(table))
        parts.append(total.join(both, "table_name"))
    return _union(parts)


def split_file_records(spark, sf_dir):
    """K4 + S4: prepared tables written as the split folders' CSV files and loaded by
    ``load_records`` as typed records, all tables and splits."""
    folder = _folder(spark, "splits")
    tables = Stages(spark, sf_dir).prep.tables
    write_split_files({t: materialize(tables[t]) for t in P.TABLES}, folder)
    recs = {t: _union([load_records(spark, folder, t, split) for split in ("train", "test", "valid")]) for t in P.TABLES}
    return _record_rows(recs)


def record_tables(spark, sf_dir):
    """S4 + P7: the records of all six contracts, one row each."""
    return _record_rows(Stages(spark, sf_dir).recs)


def _record_rows(recs) -> DataFrame:
    """(table_name, split, patient_id, fields, number) of all records."""
    out = None
    for table in P.TABLES:
        names = [n for n, _, _ in clean.CONTRACTS[table].fields if not n.startswith("_") and n != "patient_id"]
        text = [n for n in names if n not in ("value", "los")]
        numbers = [n for n in names if n in ("value", "los")]
        part = recs[table].select(
            F.lit(table).alias("table_name"), "split", "patient_id", F.concat_ws("|", *[F.col(n).cast("string") for n in text]).alias("fields"),
            (_r(numbers[0]) if numbers else F.lit(None).cast("double")).alias("number"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def prepared_round_trip(spark, sf_dir):
    """K4 + reader: all prepared tables written by split and read back into records."""
    folder = _folder(spark, "prepared")
    write_prepared(Stages(spark, sf_dir).prep.tables, folder)
    recs = P.records(read_prepared(spark, folder))
    out = None
    for table in P.TABLES:
        part = recs[table].groupBy("split").agg(
            F.count(F.lit(1)).cast("bigint").alias("n"), F.countDistinct("patient_id").cast("bigint").alias("n_patients")
        ).select(F.lit(table).alias("table_name"), "split", "n", "n_patients")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ C2


def vocabulary(spark, sf_dir):
    # Nothing else reads the records here, so their event rows are not written.
    return P.build_vocabulary(dict(Stages(spark, sf_dir).recs)).table


def vocabulary_sizes(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return V.vocabulary_sizes(st.train("diagnoses"), st.train("prescriptions"), st.train("labevents"))


# ------------------------------------------------------------------ C3


def indexed_features(spark, sf_dir):
    return Stages(spark, sf_dir).ds.features


def unknown_tokens(spark, sf_dir):
    return Stages(spark, sf_dir).ds.unknown_tokens


def dataset_labels(spark, sf_dir):
    return Stages(spark, sf_dir).ds.labels


def features_round_trip(spark, sf_dir):
    """K2 + S5: features and labels of every split written as headerless CSV part
    files in the shared folder, scanned back as whole folders and joined."""
    ds = Stages(spark, sf_dir).ds
    out = _folder(spark, "features")
    found = None
    for split in ("train", "test", "valid"):
        write_features(ds.features, ds.labels, out, split, fmt="csv")
        part = read_features(spark, f"{out}/featureDF_{split}").join(read_labels(spark, f"{out}/patientIDLabels_{split}"), "patient_id")
        part = part.select(F.lit(split).alias("split"), "patient_id", "admit_ms", "feature_id", "value", "is_dead")
        found = part if found is None else found.unionByName(part)
    return found


def sorted_sink(spark, sf_dir):
    """O1 + O2: order of the written features and labels: rows out of order inside
    a part file, and part files whose range overlaps the one before."""
    return _sorted_sink(spark, sf_dir, ("train",))


def sorted_sinks(spark, sf_dir):
    """O1 + O2 for the other splits' files."""
    return _sorted_sink(spark, sf_dir, ("test", "valid"))


def _sorted_sink(spark, sf_dir, splits) -> DataFrame:
    from pyspark.sql import Window

    ds = Stages(spark, sf_dir).ds
    out = _folder(spark, "sorted")
    result, found = None, []
    for split in splits:
        write_features(ds.features, ds.labels, out, split)
        found += [(f"featureDF_{split}", F.struct("patientID", "admitTime")), (f"patientIDLabels_{split}", F.struct("patientID"))]
    for name, key in found:
        rows = spark.read.parquet(f"{out}/{name}").select(key.alias("k"), F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("i"))
        inside = rows.withColumn("before", F.lag("k").over(Window.partitionBy("part").orderBy("i")))
        parts = inside.groupBy("part").agg(
            F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.sum(F.when(F.col("before") > F.col("k"), 1).otherwise(0)).alias("bad")
        )
        # One row per part file.
        parts = parts.withColumn("last", F.lag("hi").over(Window.orderBy("part")))
        row = parts.agg(
            F.sum("n").cast("bigint").alias("n_rows"), F.sum("bad").cast("bigint").alias("rows_out_of_order"),
            F.sum(F.when(F.col("last") > F.col("lo"), 1).otherwise(0)).cast("bigint").alias("parts_out_of_order"),
        ).select(F.lit(name).alias("data_set"), "n_rows", "rows_out_of_order", "parts_out_of_order")
        result = row if result is None else result.unionByName(row)
    return result


def salted_features(spark, sf_dir):
    """J1 + J2: the indexed features with every large join salted for the heavy keys found before it."""
    st = Stages(spark, sf_dir)
    prep = P.prepare(st.raw, salted=True)
    recs = P.records(prep.tables)
    return P.build_dataset(recs, P.build_vocabulary(recs), salted=True).features


def by_patient_join(spark, sf_dir):
    """K2 + K3 + C4: features and labels written by patient, joined and summed without a shuffle."""
    ds, folder = Stages(spark, sf_dir).ds, _folder(spark, "by_patient")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_by_patient(ds.features, folder, "features", buckets)
    write_by_patient(ds.labels, folder, "labels", buckets)
    features, labels = read_by_patient(spark, folder, "features"), read_by_patient(spark, folder, "labels")
    sums = features.groupBy("split", "patient_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.countDistinct("admit_ms").cast("bigint").alias("n_visits"))
    return labels.join(sums, ["split", "patient_id"]).select("split", "patient_id", F.col("is_dead").cast("int").alias("label"), "n_rows", "n_visits")


def num_features(spark, sf_dir):
    st = Stages(spark, sf_dir)
    return S.num_features(st.ds.features.filter(F.col("split") == "train"))


# ------------------------------------------------------------------ C4


def visit_cells(spark, sf_dir):
    return S.visit_cells(Stages(spark, sf_dir).ds.features).withColumn("value", _r("value"))


def sequence_entries(spark, sf_dir):
    return S.sequence_entries(P.build_sequences(Stages(spark, sf_dir).ds))


def hot_visit_entries(spark, sf_dir):
    """A5: the sequence entries with every visit of more than 20 entries numbered on two levels."""
    ds = Stages(spark, sf_dir).ds
    return S.sequence_entries(S.sequences(ds.features, labels=ds.labels, hot_rows=20))


def sequence_summary(spark, sf_dir):
    return S.sequence_summary(P.build_sequences(Stages(spark, sf_dir).ds))


def sequences_round_trip(spark, sf_dir):
    """K3 + S6: all splits' sequences written at once and one split on its own, read back by split."""
    out, again = _folder(spark, "sequences"), _folder(spark, "sequences")
    seqs = materialize(P.build_sequences(Stages(spark, sf_dir).ds))
    write_sequences(seqs, out)
    write_sequences(seqs, again, "test")
    found = None
    for how, folder, splits in (("all", out, ("train", "test", "valid")), ("one", again, ("train", "test"))):
        for split in splits:
            back = read_sequences(spark, f"{folder}/sequences", split)
            part = S.sequence_summary(back).select(F.lit(how).alias("written"), "split", "patient_id", "label", "n_visits", "n_entries")
            found = part if found is None else found.unionByName(part)
    return found


# ------------------------------------------------------------------ batches / vectors


def padded_batches(spark, sf_dir):
    """O3 + X2: every slot, step and entry of the padded batches."""
    return _padded(spark, sf_dir)


def padded_arrays(spark, sf_dir):
    """X2 in array form: the padded batches as arrays of at most 4 steps and 8 entries a step, flattened again."""
    return S.flat_arrays(S.padded_arrays(_padded(spark, sf_dir), steps_per_row=4, entries_per_row=8))


def _padded(spark, sf_dir) -> DataFrame:
    ds = Stages(spark, sf_dir).ds
    seqs = materialize(P.build_sequences(ds))
    lengths = S.sequence_summary(seqs).select("split", "patient_id", "label", F.col("n_visits").alias("length"))
    slots = materialize(S.batch_slots(S.assign_batches(materialize(lengths), BATCH_SIZE, seed=SHUFFLE_SEED)))
    return S.pad_batches(S.sequence_entries(seqs).drop("label"), slots)


def shuffled_rows(spark, sf_dir):
    labels = Stages(spark, sf_dir).ds.labels.select("split", "patient_id")
    return S.shuffle_rows(labels, seed=SHUFFLE_SEED)


def pooled(how: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        matrix = Stages(spark, sf_dir).matrix
        if how == "mean":
            # Mean of the 9-decimal sum: exact ties of a rounded mean would
            # depend on summation order, this does not.
            return S.pool_sequences(matrix, how, sum_digits=9)
        return S.pool_sequences(matrix, how).withColumn("value", _r("value"))

    return q


def pooled_decay_days(spark, sf_dir):
    """Decayed pooling by the days before the last visit, half-life 30 days."""
    return S.decayed_pool(Stages(spark, sf_dir).matrix, 30.0, "days").withColumn("value", _r(F.col("value") + OFF_TIES, 6))


def pooled_decay(spark, sf_dir):
    """Decayed pooling by the number of later visits, half-life two visits."""
    return S.pool_sequences(Stages(spark, sf_dir).matrix, "decay").withColumn("value", _r(F.col("value") + OFF_TIES, 6))


def minibatch_steps(spark, sf_dir):
    """L1 + W4: the coefficients after two mini-batch steps from a fixed start."""
    st = Stages(spark, sf_dir)
    pooled = materialize(S.pool_sequences(st.matrix, "sum").filter("split = 'train'"))
    labels = st.ds.labels.filter("split = 'train'")
    run = MB.train_minibatch(pooled, labels.drop("split"), MB.start_state(st.coefficients(), INTERCEPT), size=BATCH_SIZE, seed=SHUFFLE_SEED, max_steps=2)
    return run.states[-1].select("feature_id", _r("weight", 6).alias("weight"), _r("m", 6).alias("m"))


def minibatch_curve(spark, sf_dir):
    """A16 + A9: loss and accuracy of a two-epoch run, one batch per epoch holding all patients."""
    st = Stages(spark, sf_dir)
    pooled = materialize(S.pool_sequences(st.matrix, "sum").filter("split = 'train'"))
    labels = st.ds.labels.filter("split = 'train'").drop("split")
    run = MB.train_minibatch(pooled, labels, MB.start_state(st.coefficients(), INTERCEPT), epochs=2, size=1 << 40, seed=SHUFFLE_SEED)
    return run.curve.select("epoch", "n", _r("loss", 6).alias("loss"), _r("accuracy", 6).alias("accuracy"))


def visit_vectors(spark, sf_dir):
    """Width, stored entries and total of every visit vector, read from its sparse form."""
    st = Stages(spark, sf_dir)
    vecs = S.visit_vectors(S.visit_cells(st.ds.features), st.vocab.width)
    stored = vecs.select("split", "patient_id", "visit_index", F.unwrap_udt("features").alias("f"))
    return stored.select(
        "split", "patient_id", "visit_index",
        F.col("f.size").cast("bigint").alias("width"),
        F.size(F.filter("f.values", lambda x: x != 0)).cast("bigint").alias("nnz"),
        _r(F.aggregate("f.values", F.lit(0.0), lambda a, x: a + x)).alias("total"),
    )


def patient_vector_cells(spark, sf_dir):
    """X3 + J5: the non-zero entries of every labelled patient's vector (one null entry
    for an empty one), read from its sparse form."""
    st = Stages(spark, sf_dir)
    vecs = P.patient_vector_table(st.ds, st.vocab.width)
    stored = vecs.select("split", "patient_id", "label", F.unwrap_udt("features").alias("f"))
    cells = F.filter(F.arrays_zip(F.col("f.indices").alias("i"), F.col("f.values").alias("x")), lambda c: c["x"] != 0)
    e = stored.select("split", "patient_id", "label", F.explode_outer(cells).alias("c"))
    return e.select("split", "patient_id", "label", F.col("c.i").cast("bigint").alias("feature_id"), _r("c.x").alias("value"))


# ------------------------------------------------------------------ metrics


def rule_scores(spark, sf_dir):
    return Stages(spark, sf_dir).scores


def metric_summary(spark, sf_dir):
    s = Stages(spark, sf_dir).scores
    return s.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        _r(M.accuracy_expr()).alias("accuracy"),
        _r(M.log_loss_expr()).alias("log_loss"),
    )


def confusion_matrix(spark, sf_dir):
    cm = M.confusion_matrix(Stages(spark, sf_dir).scores, by=["split"], normalize=True)
    return cm.withColumn("rate", _r("rate"))


def roc_curve(spark, sf_dir):
    roc = M.roc_curve(Stages(spark, sf_dir).scores, by=["split"])
    return roc.withColumn("fpr", _r("fpr")).withColumn("tpr", _r("tpr"))


def roc_curve_turns(spark, sf_dir):
    roc = M.roc_curve(Stages(spark, sf_dir).scores, by=["split"], drop_intermediate=True)
    return roc.withColumn("fpr", _r("fpr")).withColumn("tpr", _r("tpr"))


def roc_auc(spark, sf_dir):
    return M.roc_auc(Stages(spark, sf_dir).scores, by=["split"]).withColumn("auc", _r("auc"))


def roc_bounded(spark, sf_dir):
    """W3 in bounded form against the exact curve: whether its thresholds are scores of the
    table, and every rate and the area within the stated error (twice, for the area)."""
    scores = materialize(Stages(spark, sf_dir).scores)
    size, grid = 200, 1000
    bounded = materialize(M.roc_from_sketches(M.roc_sketches(scores, by=["split"], size=size), ["split"], 100, grid))
    exact = M.roc_curve(scores, by=["split"]).select("split", "threshold", F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    gap = bounded.join(exact, ["split", "threshold"]).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.abs(F.col("fpr") - F.col("x")), F.abs(F.col("tpr") - F.col("y")))).alias("gap")
    )
    points = bounded.groupBy("split").agg(F.count(F.lit(1)).alias("n_points"))
    areas = M.auc_from_roc(bounded, by=["split"]).join(M.roc_auc(scores, by=["split"]).withColumnRenamed("auc", "exact"), "split")
    joined = gap.join(points, "split").join(areas, "split")
    error = 3 / size + 1 / grid
    return joined.select(
        "split", (F.col("n") == F.col("n_points")).alias("thresholds_are_scores"), (F.col("n_points") <= 203).alias("bounded"),
        (F.col("gap") <= error).alias("rates_within_error"), (F.abs(F.col("auc") - F.col("exact")) <= 2 * error).alias("area_within_error"),
    )


def batch_weighted_accuracy(spark, sf_dir):
    s = S.assign_batches(Stages(spark, sf_dir).scores, BATCH_SIZE, seed=SHUFFLE_SEED)
    per_batch = M.accuracy(s, by=["split", "batch_id"])
    return M.weighted_mean(per_batch, "accuracy", "n", by=["split"]).withColumn("mean", _r("mean"))


# ------------------------------------------------------------------ events as a direct source


def _event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = R.event_table(spark, sf_dir).withColumn("token", norm_token("event_type"))
    tokens = ev.select("token").filter(F.col("token").isNotNull()).distinct().select(
        F.lit("event").alias("domain"), F.lit(0).alias("domain_rank"), "token"
    )
    vocab = V.indexed_tokens(tokens).select("token", "feature_id")
    return FT.index_features(ev, vocab)


def event_visit_cells(spark, sf_dir):
    return S.visit_cells(_event_features(spark, sf_dir)).withColumn("value", _r("value"))


def event_sequence_entries(spark, sf_dir):
    return S.sequence_entries(S.sequences(_event_features(spark, sf_dir)))


# ------------------------------------------------------------------ model (no SQL oracle)


def model_predictions(spark, sf_dir):
    run = P.run_model(Stages(spark, sf_dir).ds)
    return run.report["predictions"].drop("logits")


def model_evaluation(spark, sf_dir):
    run = P.run_model(Stages(spark, sf_dir).ds)
    pred = run.report["predictions"]
    return pred.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), M.accuracy_expr(), M.log_loss_expr()
    ).join(M.roc_auc(pred, by=["split"]), "split")


def run_model_check(spark, sf_dir):
    """What can be stated of a run without its numbers: rows of the report, epochs of the
    curve, the epoch chosen (first best on validation), finite losses, and the report's AUC
    and accuracy equal to those of its own predictions."""
    run = P.run_model(Stages(spark, sf_dir).ds, epochs=(2, 5))
    pred = materialize(run.report["predictions"].drop("logits"))
    curve = run.curve.collect()  # two rows an epoch
    valid = [(r.epoch, r.accuracy) for r in curve if r.phase == "valid"]
    first = min(e for e, a in valid if a == max(x for _, x in valid))
    again = pred.groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("n_scored"), M.accuracy_expr().alias("hits"))
    one = F.lit("test").alias("split")
    joined = again.select(one, "n_scored", "hits").join(M.roc_auc(pred).select(one, F.col("auc").alias("area")), "split")
    joined = joined.join(run.report["auc"].select(one, "auc"), "split").join(run.report["accuracy"].select(one, "accuracy"), "split")
    return joined.select(
        "split", "n_scored", F.lit(len(curve)).cast("bigint").alias("curve_rows"), F.lit(run.best == first).alias("first_best_epoch"),
        F.lit(all(math.isfinite(r.loss) for r in curve)).alias("finite_losses"),
        ((F.abs(F.col("auc") - F.col("area")) < 1e-9) & (F.abs(F.col("accuracy") - F.col("hits")) < 1e-9)).alias("report_agrees"),
    )


def model_fit_check(spark, sf_dir):
    """L1: the fitted logistic model is an optimum (its gradient vanishes) and scores the
    same as its coefficient table joined to the pooled cells."""
    st = Stages(spark, sf_dir)
    # Written once, by patient: the vectors, scores and gradient of a patient need no shuffle of the cells.
    folder = _folder(spark, "pooled")
    write_by_patient(S.pool_sequences(st.matrix, "sum"), folder, "cells", int(spark.conf.get("spark.sql.shuffle.partitions")))
    pooled = read_by_patient(spark, folder, "cells")
    vectors = P.patient_vector_table(st.ds, st.vocab.width, pooled=pooled)
    train = vectors.filter("split = 'train'")
    model = ML.train_classifier(train, max_iter=300)
    table, intercept = ML.coefficient_table(model, spark)
    scored = materialize(ML.linear_scores(pooled, st.ds.labels, table, intercept))
    norm = ML.gradient_norm(pooled.filter("split = 'train'"), scored.filter("split = 'train'"), table)
    other = ML.predict(model, vectors).select("split", "patient_id", F.col("score").alias("fitted"))
    gap = scored.join(other, ["split", "patient_id"]).agg(F.max(F.abs(F.col("score") - F.col("fitted"))).alias("gap"), F.count(F.lit(1)).alias("n")).first()
    return train.agg(F.count(F.lit(1)).cast("bigint").alias("n_train")).select(
        "n_train", F.lit(int(gap["n"])).cast("bigint").alias("n_scored"), F.lit(st.vocab.width).cast("bigint").alias("width"),
        F.lit(norm < 1e-3).alias("at_optimum"), F.lit(float(gap["gap"]) < 1e-6).alias("same_scores"),
    )


def bundle_round_trip(spark, sf_dir):
    """K5 + C2 + P12: a bundle is fitted, given the fixed coefficients, saved, loaded as a
    new object, and scores the test split from event rows with labs as measured.
    ``same_after_load``: the fitted classifier too scores alike before and after."""
    fitted, events = P.fit_bundle(Stages(spark, sf_dir).raw, maxIter=5)
    fixed = fitted.with_coefficients(_fixed_coefficients(fitted.vocabulary), INTERCEPT)
    paths = [_folder(spark, "bundle"), _folder(spark, "bundle")]
    fitted.save(paths[0])
    fixed.copy({fixed.digits: 6}).save(paths[1])
    again, loaded = (load_model(p) for p in paths)
    test = materialize(events.filter("split = 'test'"))  # read by three models, each more than once
    before = fitted.transform(test).select("patient_id", F.col("score").alias("_before"))
    after = again.transform(test).select("patient_id", F.col("score").alias("_after"))
    scored = loaded.transform(test).filter("label is not null").join(before, "patient_id").join(after, "patient_id")
    same = F.abs(F.col("_before") - F.col("_after")) < F.lit(1e-9)
    return scored.select("split", "patient_id", "label", "logit", _r("score").alias("score"), "prediction", same.alias("same_after_load"))


def bundle_evaluation(spark, sf_dir):
    """L2: accuracy and loss of the fixed coefficients on every split, through a bundle."""
    fitted, events = P.fit_bundle(Stages(spark, sf_dir).raw, maxIter=1)
    model = fitted.with_coefficients(_fixed_coefficients(fitted.vocabulary), INTERCEPT)
    found = model.copy({model.digits: 6}).evaluate(events, by=["split"])
    return found.select("split", "n", _r("accuracy").alias("accuracy"), _r("log_loss").alias("log_loss"))


def new_patient_scores(spark, sf_dir):
    """L3 for new patients: raw tables of the valid split's patients, scored as if never seen:
    labs divided by the training maximum, tokens looked up in the training vocabulary."""
    st = Stages(spark, sf_dir)
    fitted, _ = P.fit_bundle(st.raw, maxIter=1)
    model = fitted.with_coefficients(_fixed_coefficients(fitted.vocabulary), INTERCEPT)
    ids = st.prep.cohort.filter("split = 'valid'").select("SUBJECT_ID")
    unseen = {t: st.raw[t].join(ids, "SUBJECT_ID", "left_semi") for t in P.TABLES}
    scored = P.score_new_patients(model.copy({model.digits: 6}), unseen)
    return scored.select("patient_id", "label", "logit", _r("score").alias("score"), "prediction")


# ------------------------------------------------------------------ linear model with fixed coefficients


def linear_predictions(spark, sf_dir):
    """L3 + P15 + P16: every labelled patient scored with the fixed coefficients."""
    s = Stages(spark, sf_dir).linear()
    return s.select("split", "patient_id", "label", "logit", _r("score").alias("score"), "prediction")


def linear_report(spark, sf_dir):
    """L2 + L4: accuracy, loss, AUC and confusion cells per split, as (metric, value)."""
    scored = materialize(Stages(spark, sf_dir).linear())
    tables = ML.report_tables(scored, by=["split"])
    one = lambda df, c: df.select("split", F.lit(c).alias("metric"), _r(F.col(c).cast("double")).alias("value"))
    cm = tables["confusion"].select("split", F.concat(F.lit("cell_"), F.col("label"), F.col("prediction")).alias("metric"), F.col("n").cast("double").alias("value"))
    out = one(tables["accuracy"], "accuracy").unionByName(one(tables["log_loss"], "log_loss"))
    return out.unionByName(one(tables["auc"], "auc")).unionByName(cm)


def _fixed_curve(spark, sf_dir) -> DataFrame:
    st = Stages(spark, sf_dir)
    curve = None
    for epoch, scale in enumerate((0.5, 1.0, 2.0)):
        phases = st.linear(scale).filter(F.col("split").isin("train", "valid")).withColumnRenamed("split", "phase")
        rows = ML.phase_metrics(phases, epoch)
        curve = rows if curve is None else curve.unionByName(rows)
    return curve.withColumn("loss", _r("loss")).withColumn("accuracy", _r("accuracy"))


def learning_curve(spark, sf_dir):
    """Loss and accuracy per epoch and phase (fixed coefficients, growing)."""
    return _fixed_curve(spark, sf_dir)


def best_epoch(spark, sf_dir):
    """The first epoch with the best validation accuracy."""
    return M.best_epoch(_fixed_curve(spark, sf_dir).filter("phase = 'valid'")).select("epoch", "accuracy")


QUERIES = {
    "prepared_admissions": prepared("admissions"),
    "prepared_diagnoses": prepared("diagnoses"),
    "prepared_icustays": prepared("icustays"),
    "prepared_labevents": prepared("labevents"),
    "prepared_patients": prepared("patients"),
    "prepared_prescriptions": prepared("prescriptions"),
    "cohort_split": cohort_split,
    "split_summary": split_summary,
    "rejects": rejects,
    "admission_records": admission_records,
    "csv_front_door": csv_front_door,
    "raw_scan": raw_scan,
    "ragged_rows": ragged_rows,
    "ragged_counts": ragged_counts,
    "split_file_records": split_file_records,
    "record_tables": record_tables,
    "prepared_round_trip": prepared_round_trip,
    "vocabulary": vocabulary,
    "vocabulary_sizes": vocabulary_sizes,
    "indexed_features": indexed_features,
    "unknown_tokens": unknown_tokens,
    "salted_features": salted_features,
    "by_patient_join": by_patient_join,
    "dataset_labels": dataset_labels,
    "features_round_trip": features_round_trip,
    "sorted_sink": sorted_sink,
    "sorted_sinks": sorted_sinks,
    "sequences_round_trip": sequences_round_trip,
    "patient_vector_cells": patient_vector_cells,
    "linear_predictions": linear_predictions,
    "linear_report": linear_report,
    "learning_curve": learning_curve,
    "best_epoch": best_epoch,
    "run_model_check": run_model_check,
    "model_fit_check": model_fit_check,
    "num_features": num_features,
    "visit_cells": visit_cells,
    "sequence_entries": sequence_entries,
    "hot_visit_entries": hot_visit_entries,
    "sequence_summary": sequence_summary,
    "padded_batches": padded_batches,
    "padded_arrays": padded_arrays,
    "shuffled_rows": shuffled_rows,
    "pooled_sum": pooled("sum"),
    "pooled_mean": pooled("mean"),
    "pooled_last": pooled("last"),
    "pooled_decay": pooled_decay,
    "pooled_decay_days": pooled_decay_days,
    "minibatch_steps": minibatch_steps,
    "minibatch_curve": minibatch_curve,
    "visit_vectors": visit_vectors,
    "rule_scores": rule_scores,
    "metric_summary": metric_summary,
    "confusion_matrix": confusion_matrix,
    "roc_curve": roc_curve,
    "roc_curve_turns": roc_curve_turns,
    "roc_auc": roc_auc,
    "roc_bounded": roc_bounded,
    "batch_weighted_accuracy": batch_weighted_accuracy,
    "event_visit_cells": event_visit_cells,
    "event_sequence_entries": event_sequence_entries,
    "bundle_round_trip": bundle_round_trip,
    "bundle_evaluation": bundle_evaluation,
    "new_patient_scores": new_patient_scores,
    "model_predictions": model_predictions,
    "model_evaluation": model_evaluation,
}
