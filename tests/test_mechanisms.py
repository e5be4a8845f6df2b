"""Fitted bundle, mini-batches, decayed pooling, skew, layouts, CSV scans, bounded ROC."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.operators import clean, cohort as C
from cohortflow.operators import features as FT
from cohortflow.operators import metrics as M
from cohortflow.operators import minibatch as MB
from cohortflow.operators import sequences as S
from cohortflow.operators.skew import heavy_keys, salted_join
from cohortflow.plans import bundle as B
from cohortflow.plans import composite as P
from cohortflow.plans import queries as Q
from cohortflow.sources import (
    load_model,
    load_records,
    read_by_patient,
    read_raw_tables,
    scan_checked,
    scan_raw,
    write_by_patient,
    write_split_files,
)
from cohortflow.sources.csv import good_rows, ragged_rejects, split_file

ONE = (100.0, 0.0, 0.0)


# --- bundle ----------------------------------------------------------------


@pytest.fixture(scope="module")
def fitted(spark, golden):
    return P.fit_bundle(golden["raw"], ONE, maxIter=5)


def test_bundle_learns_what_the_pipeline_learns(golden, fitted):
    model, events = fitted
    vocab = {(r.token, r.feature_id, r.domain) for r in golden["vocab"].table.collect()}
    assert {(r.token, r.feature_id, r.domain) for r in model.vocabulary.collect()} == vocab
    assert model.width == golden["vocab"].width
    assert model.getOrDefault(model.labMaxima) == {"train": 16.0}  # of a row without an admission id
    own = sorted(tuple(r) for r in model.features(events.filter("label is not null")).collect())
    assert own == sorted(tuple(r) for r in golden["ds"].features.collect())


def test_bundle_round_trip(spark, golden, fitted, tmp_path):
    model, events = fitted
    for kind, one in (("linear", model), ("mlp", B.CohortEstimator(kind="mlp", maxIter=3, labMaxima={"train": 16.0}).fit(events))):
        path = str(tmp_path / kind)
        one.save(path)
        with pytest.raises(Exception, match="exist"):
            one.save(path)
        one.write().overwrite().save(path)
        for again in (B.CohortModel.load(path), load_model(path)):
            assert type(again) is B.CohortModel and again.uid == one.uid and again.width == one.width
            assert again.extractParamMap() == one.extractParamMap()
            a, b = ({r.patient_id: (r.score, r.prediction, r.label) for r in m.transform(events).collect()} for m in (one, again))
            assert a.keys() == b.keys() and len(a) == 3
            assert all(abs(a[k][0] - b[k][0]) < 1e-12 and a[k][1:] == b[k][1:] for k in a)
    est = B.CohortEstimator(pooling="decay", regParam=0.5)
    est.save(str(tmp_path / "estimator"))
    assert load_model(str(tmp_path / "estimator")).extractParamMap() == est.extractParamMap()


def test_bundle_scores_patients_it_never_saw(spark, fitted):
    model, _ = fitted
    table = model.vocabulary.select("feature_id", F.lit(1.0).alias("weight"))
    flat = model.with_coefficients(table, 0.5)
    text = lambda rows, cols: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols.split()))
    raw = {
        "admissions": text([("77", "1", "2105-01-01 00:00:00"), ("78", "2", "2105-01-01 00:00:00"), ("79", "3", "2105-01-01 00:00:00")], "SUBJECT_ID HADM_ID ADMITTIME"),
        "diagnoses": text([("77", "1", "4019"), ("77", "1", "99999"), ("79", "3", "88888")], "SUBJECT_ID HADM_ID ICD9_CODE"),
        "icustays": text([("78", "2", "5", "2.5")], "SUBJECT_ID HADM_ID ICUSTAY_ID LOS"),
        "labevents": text([("77", "1", "50912", "4.0"), ("77", "1", "50912", "n/a"), ("78", "9", "50912", "8.0")], "SUBJECT_ID HADM_ID ITEMID VALUENUM"),
        "patients": text([("77", "x"), ("79", None)], "SUBJECT_ID DOD_HOSP"),
        "prescriptions": text([], "SUBJECT_ID HADM_ID DRUG"),
    }
    got = {r.patient_id: (r.label, round(r.logit, 9)) for r in P.score_new_patients(flat, raw).collect()}
    # 77: one known code, a lab of 4 over the training maximum 16; 78: a stay of 2.5, its lab has
    # no admission; 79: nothing known.
    assert got == {77: (1, 0.5 + 1.0 + 0.25), 78: (None, 0.5 + 2.5)}
    assert P.score_new_patients(flat, {t: df.limit(0) for t, df in raw.items()}).count() == 0


def test_bundle_without_classifier_or_with_two_labels_fails(spark, fitted, tmp_path):
    model, events = fitted
    bare = B.CohortModel(model.vocabulary, model.width)
    with pytest.raises(ValueError):
        bare.transform(events)
    with pytest.raises(Exception, match="no classifier"):
        bare.save(str(tmp_path / "bare"))
    assert model.evaluate(events).first().n == 3


# --- mini-batches ----------------------------------------------------------


def plain_adam(cells, labels, weights, batches, epochs=1):
    """The same steps with numpy; ``batches``: patients per epoch and batch."""
    ids = sorted(weights)
    w = np.array([weights[i] for i in ids])
    m, v, t, curve = np.zeros_like(w), np.zeros_like(w), 0, []
    for e in range(epochs):
        seen = []
        for batch in batches[e]:
            t += 1
            x = np.array([[1.0 if i == MB.INTERCEPT_ID else cells.get((p, i), 0.0) for i in ids] for p in batch])
            y = np.array([labels[p] for p in batch])
            s = 1 / (1 + np.exp(-(x @ w)))
            seen += [(-(b * math.log(a) + (1 - b) * math.log(1 - a)), (a > 0.5) == b) for a, b in zip(s, y, strict=True)]
            g = x.T @ (s - y) / len(batch) + MB.DECAY * w
            m, v = MB.BETA1 * m + (1 - MB.BETA1) * g, MB.BETA2 * v + (1 - MB.BETA2) * g * g
            w = w - MB.RATE * (m / (1 - MB.BETA1**t)) / (np.sqrt(v / (1 - MB.BETA2**t)) + MB.EPSILON)
        curve.append((len(seen), sum(a for a, _ in seen) / len(seen), 100 * sum(b for _, b in seen) / len(seen)))
    return dict(zip(ids, w, strict=True)), curve


def test_minibatch_equals_plain_steps(spark):
    rnd = random.Random(5)
    labels = {p: rnd.randint(0, 1) for p in range(23)}
    cells = {(p, f): rnd.random() for p in range(22) for f in rnd.sample(range(6), 3)}  # patient 22 has none
    start = {f: rnd.uniform(-1, 1) for f in range(5)}  # feature 5 is not learnt
    pooled = spark.createDataFrame([(p, f, x) for (p, f), x in cells.items()], "patient_id bigint, feature_id bigint, value double")
    frame = spark.createDataFrame(list(labels.items()), "patient_id bigint, is_dead int")
    state = MB.start_state(spark.createDataFrame(list(start.items()), "feature_id bigint, weight double"), 0.1)
    run = MB.train_minibatch(pooled, frame, state, epochs=2, size=5, seed=3)
    batches = []
    for e in range(2):
        rows = S.assign_batches(frame.select("patient_id"), 5, 3 + e).collect()
        batches.append([[r.patient_id for r in rows if r.batch_id == b] for b in range(5)])
    assert batches[0] != batches[1] and run.steps == 10
    for epochs in (1, 2):
        want, curve = plain_adam(cells, labels, {**start, MB.INTERCEPT_ID: 0.1}, batches, epochs)
        got = {r.feature_id: r.weight for r in run.states[epochs - 1].collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    found = sorted(tuple(r) for r in run.curve.collect())
    assert [(e, n) for e, n, _, _ in found] == [(0, 23), (1, 23)]
    assert all(abs(x - y) < 1e-9 for (_, _, *a), (_, *b) in zip(found, curve, strict=True) for x, y in zip(a, b, strict=True))
    assert abs(run.intercept() - got[MB.INTERCEPT_ID]) < 1e-12 and run.coefficients().count() == 5


def test_minibatch_without_patients_keeps_the_start(spark):
    state = MB.start_state(spark.createDataFrame([(0, 0.5)], "feature_id bigint, weight double"))
    none = spark.createDataFrame([], "patient_id bigint, is_dead int")
    run = MB.train_minibatch(spark.createDataFrame([], "patient_id bigint, feature_id bigint, value double"), none, state)
    assert run.steps == 0 and run.curve is None and run.coefficients().first().weight == 0.5


# --- decayed pooling -------------------------------------------------------


def test_decayed_pool_is_the_recurrence(spark):
    rnd = random.Random(1)
    rows = [(p, rnd.randint(0, 400) * 86_400_000, f, rnd.random()) for p in range(6) for f in range(4) for _ in range(rnd.randint(1, 9))]
    cells = S.visit_matrix(spark.createDataFrame(rows, "patient_id bigint, admit_ms bigint, feature_id bigint, value double"))
    for age, gap in (("visits", lambda a, b: 1.0), ("days", lambda a, b: (b - a) / 86_400_000)):
        want = {}
        for p in range(6):
            state, last = {}, None
            for day in sorted({r[1] for r in rows if r[0] == p}):
                if last is not None:
                    state = {f: x * 2 ** (-gap(last, day) / 3.0) for f, x in state.items()}
                for _, d, f, x in rows:
                    if _ == p and d == day:
                        state[f] = state.get(f, 0.0) + x
                last = day
            want.update({(p, f): x for f, x in state.items()})
        got = {(r.patient_id, r.feature_id): r.value for r in S.decayed_pool(cells, 3.0, age).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    with pytest.raises(ValueError):
        S.decayed_pool(cells, 0.0)
    assert S.decayed_pool(cells.limit(0)).count() == 0


def test_run_model_with_decay(golden):
    ds = golden["ds"]
    ds = P.Dataset(ds.recs, ds.vocab)
    three = lambda df: df.unionByName(df.withColumn("split", F.lit("valid"))).unionByName(df.withColumn("split", F.lit("test")))
    ds.__dict__.update(features=three(golden["ds"].features), labels=three(golden["ds"].labels))
    run = P.run_model(ds, how="decay", epochs=(2,))
    assert run.report["predictions"].count() == 3 and run.best == 0


# --- skew ------------------------------------------------------------------


def test_salted_join_spreads_a_hot_key(spark):
    n = 40_000
    left = spark.range(n, numPartitions=4).select(F.when(F.col("id") % 20 < 6, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("k"), F.col("id").alias("x"))
    right = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")).unionByName(spark.createDataFrame([(1, -1), (None, 5)], "k bigint, y bigint"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, x in zip(old, ("false", "-1", "16"), strict=True):
            spark.conf.set(c, x)
        heavy = heavy_keys(left, ["k"])
        assert len(heavy) == 1
        sizes = lambda df: sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())
        plain, salted = left.join(right, "k"), salted_join(left, right, ["k"], heavy)
        assert sizes(plain)[-1] > 5 * sizes(plain)[8]
        assert sizes(salted)[-1] < 3 * sizes(salted)[8]
        for how in ("inner", "left", "left_semi", "left_anti"):
            a, b = left.join(right, "k", how), salted_join(left, right, ["k"], heavy, how=how)
            total = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(30,0)"))).first()
            assert tuple(total(a)) == tuple(total(b)), how
    finally:
        for c, x in old.items():
            spark.conf.set(c, x)
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], [1], how="outer")
    assert heavy_keys(left.limit(0), ["k"]) == [] and heavy_keys(left.withColumn("k", F.lit(None).cast("bigint")), ["k"]) == []


def test_hot_visit_is_numbered_by_several_tasks(spark):
    busy = spark.range(100_000, numPartitions=4).select(F.lit(1).cast("bigint").alias("patient_id"), F.lit(0).cast("bigint").alias("admit_ms"), (F.xxhash64("id") % 50).alias("feature_id"), F.lit(1.0).alias("value"))
    calm = spark.createDataFrame([(2, 0, 3, 1.0), (2, 0, 1, 2.0), (2, 5, 1, None)], "patient_id bigint, admit_ms bigint, feature_id bigint, value double")
    feats = busy.unionByName(calm)
    key = ["patient_id", "visit_index", "entry_index", "feature_id", "value"]
    digest = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*key).cast("decimal(30,0)"))).first())
    plain = S.sequence_entries(S.sequences(feats, hot_rows=1 << 40))
    levels = S.sequence_entries(S.sequences(feats, hot_rows=1000))
    assert digest(plain) == digest(levels) and digest(plain)[0] == 100_003
    # The hot visit's rows are range-partitioned: no task orders them all.
    from cohortflow.operators.ordering import global_index

    parts = global_index(busy.withColumn("_row", F.monotonically_increasing_id()), ["feature_id", "value", "_row"], "at").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 70_000


# --- CSV and layouts -------------------------------------------------------


def test_scan_raw_checks_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ROW_ID,SUBJECT_ID,HADM_ID,ADMITTIME\n9,1,2,2101-01-01\n")
    header = ["ROW_ID", "SUBJECT_ID", "HADM_ID", "ADMITTIME"]
    assert [tuple(r) for r in scan_raw(spark, str(tmp_path / "a.csv"), "admissions", header).collect()] == [("1", "2", "2101-01-01")]
    for wrong in (["SUBJECT_ID", "HADM_ID", "ADMITTIME"], [*header, "X"], ["ROW_ID", "HADM_ID", "SUBJECT_ID", "ADMITTIME"]):
        with pytest.raises(Exception, match="(?i)header|schema"):
            scan_raw(spark, str(tmp_path / "a.csv"), "admissions", wrong).collect()
    with pytest.raises(ValueError):
        scan_raw(spark, str(tmp_path / "a.csv"), "admissions", ["ROW_ID"])


def test_ragged_rows_are_kept_as_rejects(spark, tmp_path):
    (tmp_path / "b.csv").write_text('SUBJECT_ID,HADM_ID,DRUG\n1,2,a\n3\n4,5,"x,y"\n6,7,c,d\n8,9,\n')
    rows = scan_checked(spark, str(tmp_path / "b.csv"))
    assert [tuple(r) for r in good_rows(rows).collect()] == [("1", "2", "a"), ("4", "5", "x,y"), ("8", "9", None)]
    bad = ragged_rejects(rows, "prescriptions").collect()
    assert [(r.subject_id, r.record, r.reason) for r in bad] == [("3", "3", "ragged row"), ("6", "6,7,c,d", "ragged row")]
    assert rows.select("_ragged_row").count() == 5 and ragged_rejects(rows, "x").count() == 2


def test_split_folders_load(spark, golden, tmp_path):
    out = str(tmp_path / "splits")
    write_split_files(golden["prep"].tables, out, splits=("train",))
    for table in P.TABLES:
        got = sorted(tuple(r) for r in load_records(spark, out, table, "train").select(*golden["recs"][table].columns).collect())
        assert got == sorted(tuple(r) for r in golden["recs"][table].collect()), table
    # Single files, one folder deeper, as the split step leaves them.
    deep = tmp_path / "deep" / "test" / "prescripts"
    deep.mkdir(parents=True)
    (deep / "prescripts_test.csv").write_text("SUBJECT_ID,HADM_ID,DRUG\n1,2,x\n")
    assert load_records(spark, str(tmp_path / "deep"), "prescriptions", "test").count() == 1
    with pytest.raises(FileNotFoundError):
        split_file(spark, str(tmp_path / "deep"), "patients", "test")


def test_layout_by_patient_joins_without_a_shuffle(spark, golden, tmp_path):
    ds, out = golden["ds"], str(tmp_path)
    for name, df in (("features", ds.features), ("labels", ds.labels), ("sequences", P.build_sequences(ds))):
        write_by_patient(df, out, name, 3)
    f, lab, seqs = (read_by_patient(spark, out, n) for n in ("features", "labels", "sequences"))
    assert sorted(tuple(r) for r in f.collect()) == sorted(tuple(r) for r in ds.features.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = ["split", "patient_id"]
        joined = lab.join(f.groupBy(*keys).agg(F.sum("value").alias("s")), keys).join(seqs, keys)
        assert joined.count() >= 3
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(FileNotFoundError):
        read_by_patient(spark, out, "nothing")


def test_read_raw_tables_still_reads(spark, fixture_dir):
    assert read_raw_tables(spark, fixture_dir)["patients"].count() == 5


# --- bounded ROC -----------------------------------------------------------


def test_bounded_roc_is_within_its_error(spark):
    rng = np.random.default_rng(0)
    n = 20_000
    label = rng.integers(0, 2, n)
    score = 1 / (1 + np.exp(-(rng.standard_normal(n) + label)))
    rows = [(int(y), float(s)) for y, s in zip(label, score, strict=True)] + [(1, None), (None, 0.5)]
    pred = spark.createDataFrame(rows, "label int, score double")
    half = [pred.filter(F.col("score") < 0.4), pred.filter(F.col("score") >= 0.4)]
    size, grid = 400, 2000
    whole = M.roc_sketches(pred, size=size)
    merged = M.merge_roc_sketches(M.roc_sketches(half[0], size=size).unionByName(M.roc_sketches(half[1], size=size)), size=size)
    exact = {y: np.sort(score[label == y]) for y in (0, 1)}
    auc = M.roc_auc(pred.filter("score is not null and label is not null")).first().auc
    for sketches in (whole, merged):
        assert {r.label: r.n for r in sketches.collect()} == {y: len(exact[y]) for y in (0, 1)}
        points = M.roc_from_sketches(sketches, points=50, grid=grid).collect()
        assert len(points) <= 103 and max(p.threshold for p in points) == float("inf")
        for p in points:
            for y, got in ((0, p.fpr), (1, p.tpr)):
                assert abs(got - (len(exact[y]) - np.searchsorted(exact[y], p.threshold)) / len(exact[y])) <= 3 / size + 1 / grid
        table = spark.createDataFrame([tuple(p) for p in points], "threshold double, fpr double, tpr double")
        assert abs(M.auc_from_roc(table).first().auc - auc) < 2 * (3 / size + 1 / grid)
    only = M.roc_from_sketches(M.roc_sketches(pred.filter("label = 1"), size=size), points=5).collect()
    assert all(p.fpr is None for p in only) and len(only) <= 7
    assert M.roc_from_sketches(M.roc_sketches(pred.limit(0), size=size)).count() == 0


# --- warm epochs, array form -----------------------------------------------


def test_perceptron_epochs_go_on_from_each_other(spark):
    from pyspark.ml.linalg import Vectors

    from cohortflow.operators import model as ML

    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 5))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.standard_normal(120) > 0).astype(int)
    rows = [(s, i, int(y[i]), Vectors.dense(x[i].tolist())) for i in range(120) for s in (("train",) if i < 90 else ("valid",))]
    vectors = spark.createDataFrame(rows, ["split", "patient_id", "label", "features"])
    fitted = ML.train_epochs(vectors, 5, "mlp", epochs=(3, 6, 40))
    loss = {r.epoch: r.loss for r in fitted.curve.filter("phase = 'train'").collect()}
    assert loss[0] > loss[1] > loss[2]
    # A further epoch of one iteration starts where the last one ended: it cannot be far from it.
    last = ML.load_epoch(fitted, 2)
    again = ML.train_classifier(vectors.filter("split = 'train'"), 5, "mlp", max_iter=1, start=last.weights)
    near = ML.evaluate(again, vectors.filter("split = 'train'")).first().log_loss
    cold = ML.evaluate(ML.train_classifier(vectors.filter("split = 'train'"), 5, "mlp", max_iter=1), vectors.filter("split = 'train'")).first().log_loss
    assert near <= loss[2] + 1e-6 < cold


def test_padded_arrays_hold_the_long_form(spark):
    entries = [(1, s, e, 10 * s + e, float(e)) for s in range(5) for e in range(7)] + [(2, 0, 0, 3, 1.0)]
    frame = spark.createDataFrame(entries, "patient_id bigint, visit_index bigint, entry_index bigint, feature_id bigint, value double")
    lengths = spark.createDataFrame([(1, 5, 0, 0), (2, 1, 0, 1)], "patient_id bigint, length bigint, batch_id bigint, position bigint")
    padded = S.pad_batches(frame, S.batch_slots(lengths))
    arrays = S.padded_arrays(padded, steps_per_row=2, entries_per_row=3)
    rows = arrays.collect()
    assert all(len(r.steps) <= 2 and all(1 <= len(s) <= 3 for s in r.steps) for r in rows)
    for p in (1, 2):
        assert sum(len(r.steps) for r in rows if r.patient_id == p and r.first_entry == 0) == 5
    key = lambda df: sorted((tuple(r) for r in df.select(*padded.columns).collect()), key=repr)
    assert key(S.flat_arrays(arrays)) == key(padded)
    assert S.padded_arrays(padded.limit(0)).count() == 0


# --- event rows written once -------------------------------------------------


def test_vocabulary_and_features_read_the_same_event_rows(golden):
    recs = golden["recs"]
    assert golden["ds"].source_events is recs.events
    for namespaced in (False, True):
        held, plain = (P.build_vocabulary(r, namespaced=namespaced).table for r in (recs, dict(recs)))
        assert held.columns == plain.columns and sorted(map(tuple, held.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("salted", [False, True])
def test_visits_of_labelled_patients_in_one_join(spark, salted):
    rnd = random.Random(4)
    split = lambda: rnd.choice(["train", "test"])
    some = lambda n: rnd.choice([None, *range(n)])
    events = spark.createDataFrame([(split(), some(4), rnd.choice([None, "a", "b"]), i % 5, float(i)) for i in range(200)], "split string, patient_id bigint, hadm_id string, feature_id bigint, value double")
    adm = spark.createDataFrame([(split(), some(4), rnd.choice([None, "a", "b"]), i) for i in range(12)], "split string, patient_id bigint, hadm_id string, admit_ms bigint")
    # Two label rows for some, none for others, and a patient in both splits.
    who = spark.createDataFrame([("train", 0), ("train", 0), ("test", 0), ("train", 1), ("test", None)], "split string, patient_id bigint")
    two = FT.features_of_labelled(FT.attach_visit(events, adm), who)
    one = FT.attach_labelled_visit(events, adm, who, salted)
    assert one.columns == two.columns and two.count() > 0
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_largest_lab_of_a_cohort_from_one_row_a_patient(spark):
    labs = spark.createDataFrame([("1", 2.0), ("1", None), ("2", 5.0), ("2", -1.0), ("3", 9.0), (None, 99.0), ("4", None)], "SUBJECT_ID string, VALUENUM double")
    cohort = spark.createDataFrame([("1", "train"), ("2", "train"), ("4", "test")], "SUBJECT_ID string, split string")
    assert [tuple(r) for r in C.cohort_max(labs, cohort).filter("max_value is not null").collect()] == [("train", 5.0)]
    got = C.max_normalize(C.restrict_to_cohort(labs, cohort).filter("VALUENUM is not null"), maxima=C.cohort_max(labs, cohort))
    assert sorted(r.VALUENUM for r in got.collect()) == [-0.2, 0.4, 1.0]


def test_short_visits_need_no_numbers(spark):
    rows = [("train", p, d, f, v) for p in (1, 2) for d in (0, 5) for f, v in ((3, 1.0), (1, 2.0), (1, None), (1, -2.0), (3, 1.0))] + [("train", 1, 9, f, 0.5) for f in range(7)]
    feats = spark.createDataFrame(rows, "split string, patient_id bigint, admit_ms bigint, feature_id bigint, value double")
    entries = lambda **cut: sorted(map(tuple, S.sequence_entries(S.sequences(feats, **cut)).collect()), key=str)
    plain = entries()
    for cut in ({"entries_per_row": 2}, {"entries_per_row": 5}, {"hot_rows": 5}, {"hot_rows": 1}, {"hot_rows": 6, "entries_per_row": 3}):
        assert entries(**cut) == plain
    sizes = S.visit_sizes(feats)
    assert "Window" not in S.visits(feats, sizes=sizes)._jdf.queryExecution().executedPlan().toString()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_convert_every_source_once(spark):
    texts = [None, "", " ", "\t", "1", " 7 ", "x", "P9", "E8880", "\tE12 ", "40", "1.5", "NaN", "2101-10-20 08:00:00", "2101", "2101-13-45"]
    for table, contract in clean.CONTRACTS.items():
        rows = [tuple(a if i == j else b for j in range(len(contract.required))) for i in range(len(contract.required)) for a in texts for b in ("1", "2101-01-02", "E1")]
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in contract.required))
        got, checked = clean.to_records(df, table), clean.validate(df, table).filter("reject_reason is null")
        assert sorted(map(str, got.collect())) == sorted(map(str, checked.select(*got.columns).collect()))
    # A filter that moves below a projection holds the whole expression at every mention.
    diagnoses = spark.range(9).select(F.lit("1").alias("HADM_ID"), F.concat(F.lit("E"), "id").alias("SUBJECT_ID"), F.col("id").cast("string").alias("ICD9_CODE"))
    filters = [line for line in clean.to_records(diagnoses, "diagnoses")._jdf.queryExecution().optimizedPlan().toString().split("+- ") if line.startswith("Filter")]
    assert filters and all(f.count("trim(") <= 1 and f.count("concat(") <= 1 for f in filters)


def test_counts_of_a_patient_do_not_double_the_rows(spark):
    rows = [("train", 1, 0, 3), ("train", 1, 0, 3), ("train", 1, 5, 3), ("train", 1, 5, 4), ("test", 1, 0, 3), ("test", 2, 1, 1), ("test", 2, 2, 1)]
    feats = spark.createDataFrame(rows, "split string, patient_id bigint, admit_ms bigint, feature_id bigint")
    got = Q._patient_counts(feats)
    assert sorted(map(tuple, got.collect())) == [("test", 1, 1, 1), ("test", 2, 2, 1), ("train", 1, 2, 2)]
    assert "Expand" not in plan_of(got)


def test_event_rows_are_not_sorted_for_their_visits(spark, golden):
    recs = golden["recs"]
    events = FT.all_events(recs["diagnoses"], recs["prescriptions"], recs["labevents"], recs["icustays"])
    labels = S.unique_labels(recs["patients"].select("split", "patient_id", "is_dead"))
    plain = events.join(recs["admissions"].select("patient_id", "hadm_id", "admit_ms"), ["patient_id", "hadm_id"], "left").join(labels, ["split", "patient_id"], "left")
    got = B.event_rows(recs)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(*B.COLUMNS).collect()))
    assert "ShuffledHashJoin" in plan_of(got) and "SortMergeJoin" not in plan_of(got)
