"""Event rows of the cohort in one shuffle, batches in a bounded number of folders, shuffle files of stage tables."""

import glob
import os
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortflow.operators import features as FT, minibatch as MB, sequences as S
from cohortflow.plans import bundle as B
from cohortflow.plans import composite as P
from cohortflow.session import materialize


def raw_tables(spark, seed, ids):
    """Raw tables with repeated and missing rows; ``ids``: the patient ids as written."""
    rnd = random.Random(seed)
    text = lambda rows, cols: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols.split()))
    sid, stay = lambda: rnd.choice(ids), lambda: rnd.choice([None, "", *map(str, range(9))])
    day = lambda: rnd.choice([None, "2101", "2101-13-45 00:00:00", "2101-10-20 19:08:00", "2101-10-25 01:00:00"])
    number = lambda: rnd.choice([None, "", "n/a", "0", "2.5", "-1", "16", "NaN"])
    patients = [(p, rnd.choice([None, "2102-01-09"])) for p in dict.fromkeys(ids) if p is not None and rnd.random() < 0.8]
    return {
        "admissions": text([(sid(), stay(), day()) for _ in range(60)], "SUBJECT_ID HADM_ID ADMITTIME"),
        "diagnoses": text([(sid(), stay(), rnd.choice([None, " ", "4019", "E8889", "\t4280 "])) for _ in range(200)], "SUBJECT_ID HADM_ID ICD9_CODE"),
        "icustays": text([(sid(), stay(), rnd.choice([None, None, "7"]), number()) for _ in range(40)], "SUBJECT_ID HADM_ID ICUSTAY_ID LOS"),
        "labevents": text([(sid(), stay(), rnd.choice([None, "", "a", "b"]), number()) for _ in range(200)], "SUBJECT_ID HADM_ID ITEMID VALUENUM"),
        "patients": text(patients, "SUBJECT_ID DOD_HOSP"),
        "prescriptions": text([(sid(), stay(), rnd.choice([None, "", " Aspirin ", "428"])) for _ in range(200)], "SUBJECT_ID HADM_ID DRUG"),
    }


PLAIN = [None, "", "x", *map(str, range(12))]
ODD = [*PLAIN, "01", " 1", "+2", "3 ", "007"]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("seed, ids", [(1, PLAIN), (2, ODD), (3, ODD)])
def test_one_shuffle_gives_the_rows_of_the_joins(spark, seed, ids):
    raw = {t: materialize(df) for t, df in raw_tables(spark, seed, ids).items()}
    weights = (50.0, 25.0, 25.0)
    # Features: the joins one after the other, from the tables alone.
    recs, plain = (P.records(t) for t in (P.prepare(raw, weights).tables, dict(P.prepare(raw, weights).tables)))
    assert recs.visit_events is not None and plain.visit_events is None
    vocabs = [P.build_vocabulary(r) for r in (recs, plain)]
    assert rows(vocabs[0].table) == rows(vocabs[1].table) and vocabs[0].table.count() > 3
    one, many = (P.build_dataset(r, v) for r, v in zip((recs, plain), vocabs, strict=True))
    assert one.features.columns == many.features.columns and rows(one.features) == rows(many.features) and one.features.count() > 0
    assert rows(one.unknown_tokens) == rows(many.unknown_tokens) and rows(one.labels) == rows(many.labels)
    # Event rows of a bundle, labs as measured, and the largest of them.
    held = P.prepare(raw, weights, normalize_labs=False)
    recs, plain = P.records(held.tables), P.records(dict(held.tables))
    if "01" in ids:  # two label rows of one patient and split fail both
        raw["patients"] = raw["patients"].filter("SUBJECT_ID = cast(try_cast(SUBJECT_ID as bigint) as string)")
        held = P.prepare(raw, weights, normalize_labs=False)
        recs, plain = P.records(held.tables), P.records(dict(held.tables))
    got, want = B.event_rows(recs), B.event_rows(plain)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 0
    top = held.tables["labevents"].select("split", "VALUENUM")
    assert rows(held.lab_maxima(got)) == rows(top.groupBy("split").agg(F.max("VALUENUM").alias("max_value")))


def test_event_rows_meet_their_patient_and_visit_in_one_join(spark):
    raw = {t: materialize(df) for t, df in raw_tables(spark, 5, PLAIN).items()}
    seen = []
    plain, FT.placed_events = FT.placed_events, lambda *a: seen.append(plain(*a)) or seen[0]
    try:
        assert B.event_rows(P.records(P.prepare(raw, normalize_labs=False).tables)).count() > 0
    finally:
        FT.placed_events = plain
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "rightHint=(strategy=shuffle_hash)" in plan


def test_batches_lie_in_a_bounded_number_of_folders(spark):
    n, found = 300, []
    pooled = spark.range(n).select(F.col("id").alias("patient_id"), (F.col("id") % 3).alias("feature_id"), F.lit(1.0).alias("value"))
    labels = spark.range(n).select(F.col("id").alias("patient_id"), (F.col("id") % 2).cast("int").alias("is_dead"))
    start = MB.start_state(spark.createDataFrame([(i, 0.1) for i in range(3)], "feature_id bigint, weight double"))
    write, release = MB.materialize_at, MB.release_tables
    MB.materialize_at, MB.release_tables = (lambda df, *by: found.append(write(df, *by)) or found[-1]), lambda paths: None
    try:
        run = MB.train_minibatch(pooled, labels, start, size=1, max_steps=2)
    finally:
        MB.materialize_at, MB.release_tables = write, release
    assert run.steps == 2 and run.curve.first().n == 2
    folders = [len(glob.glob(path.replace("file:", "") + "/batch*=*")) for _, path in found]
    assert sum(x > 1 for x in folders) == 2 and max(folders) <= MB.FOLDERS < n
    MB.release_tables([path for _, path in found])


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {os.path.basename(f) for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_a_stage_table_leaves_no_shuffle_files(spark):
    counts = lambda: spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    before, held = shuffle_files(spark), counts()
    table = materialize(held)
    # The collector may free older ones meanwhile, so only new ones count.
    assert not shuffle_files(spark) - before and table.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    # The frame that was written still works.
    assert held.count() == 100


def test_cells_of_a_patient_are_shuffled_once_for_pooling(spark):
    feats = spark.createDataFrame([("train", 1, d, f, 1.0) for d in (0, 0, 5) for f in (1, 2)] + [("test", 1, 0, 1, 2.0)], "split string, patient_id bigint, admit_ms bigint, feature_id bigint, value double")
    pooled = S.pool_sequences(S.visit_matrix(feats), "sum")
    assert pooled._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, pooled.collect())) == [("test", 1, 1, 2.0), ("train", 1, 1, 3.0), ("train", 1, 2, 3.0)]


def test_vectors_are_built_without_python(spark):
    cells = spark.createDataFrame([("train", 1, 4, 2.0), ("train", 1, 0, 1.0), ("test", 2, 3, -1.0)], "split string, patient_id bigint, feature_id bigint, value double")
    parts = S.assembled(cells, ["split", "patient_id"], 5, "features")
    assert "Python" not in parts._jdf.queryExecution().executedPlan().toString()
    vectors = {r.patient_id: r.features for r in S.patient_vectors(cells, 5).collect()}
    assert vectors == {1: Vectors.sparse(5, [0, 4], [1.0, 2.0]), 2: Vectors.sparse(5, [3], [-1.0])}


def test_model_check_pools_once_and_by_patient(spark):
    import __spark_entry__ as E

    pooled, plain = [], S.pool_sequences
    S.pool_sequences = lambda *a, **b: pooled.append(plain(*a, **b)) or pooled[-1]
    try:
        row = E.queries()["model_fit_check"](spark, E.SMOKE_DIR).first()
    finally:
        S.pool_sequences = plain
    assert len(pooled) == 1 and row.at_optimum and row.same_scores and row.n_scored >= row.n_train > 0
