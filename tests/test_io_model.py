"""Sinks, readers and model persistence on the hospital fixture."""

from pyspark.sql import functions as F

from cohortflow.operators import cohort as C
from cohortflow.operators import model as ML
from cohortflow.operators import sequences as S
from cohortflow.plans import composite as P
from cohortflow.sources import (
    load_model,
    read_sequences,
    save_model,
    write_prepared,
    write_sequences,
)


def test_prepared_round_trip(spark, golden, tmp_path):
    out = str(tmp_path / "prepared")
    write_prepared(golden["prep"].tables, out)
    back = spark.read.parquet(f"{out}/labevents")
    assert back.filter(F.col("split") == "train").count() == 4
    assert sorted(r.VALUENUM for r in back.collect()) == [0.125, 0.25, 0.5, 1.0]


def test_sequences_round_trip(spark, golden, tmp_path):
    seqs = P.build_sequences(golden["ds"])
    out = str(tmp_path / "seq")
    write_sequences(seqs, out)
    back = read_sequences(spark, f"{out}/sequences", "train")
    assert sorted((r.patient_id, r.label, len(r.seq)) for r in back.collect()) == [(1, 0, 2), (2, 1, 1), (5, 0, 1)]


def test_sinks_write_one_split_only(spark, golden, tmp_path):
    import pytest

    from cohortflow.sources import read_features, read_labels, write_features

    seqs = P.build_sequences(golden["ds"])
    both = seqs.withColumn("split", F.when(F.col("patient_id") == 2, "test").otherwise("train"))
    out = str(tmp_path / "one")
    write_sequences(both, out, "train")
    assert sorted(r.patient_id for r in spark.read.parquet(f"{out}/sequences").collect()) == [1, 5]
    with pytest.raises(ValueError):
        write_sequences(both.drop("split"), out)
    ds = golden["ds"]
    mark = lambda df: df.withColumn("split", F.when(F.col("patient_id") == 2, "test").otherwise("train"))
    write_features(mark(ds.features), mark(ds.labels), out, "test")
    assert {r.patient_id for r in read_features(spark, f"{out}/featureDF_test").collect()} == {2}
    assert [r.patient_id for r in read_labels(spark, f"{out}/patientIDLabels_test").collect()] == [2]


def test_prepare_files_and_read_back(spark, fixture_dir, golden, tmp_path):
    from cohortflow.sources import load_records, read_prepared

    out = str(tmp_path / "prepared")
    P.prepare_files(spark, fixture_dir, out, weights=(100.0, 0.0, 0.0))
    recs = P.records(read_prepared(spark, out))
    for t in P.TABLES:
        assert sorted(map(str, recs[t].collect())) == sorted(map(str, golden["recs"][t].collect())), t
    csv = str(tmp_path / "csv")
    golden["prep"].tables["patients"].drop("split").write.option("header", True).csv(f"{csv}/patients_train.csv")
    back = load_records(spark, csv, "patients", "train")
    assert sorted((r.split, r.patient_id, r.is_dead) for r in back.collect()) == sorted((r.split, r.patient_id, r.is_dead) for r in golden["recs"]["patients"].collect())


def test_patient_without_cells_gets_an_empty_vector(spark, golden):
    class Fake:
        features = golden["ds"].features.filter("patient_id <> 5")
        labels = golden["ds"].labels

    vecs = {r.patient_id: r.features for r in P.patient_vector_table(Fake, 12).collect()}
    assert sorted(vecs) == [1, 2, 5] and vecs[5].numNonzeros() == 0 and vecs[1].numNonzeros() > 0


def test_id_outside_the_width_fails(golden):
    import pytest

    with pytest.raises(Exception, match="outside the width"):
        S.patient_vectors(S.pool_sequences(S.visit_matrix(golden["ds"].features)), 5).collect()


def test_two_labels_of_one_patient_fail(golden):
    import pytest

    class Twice:
        features = golden["ds"].features
        labels = golden["ds"].labels.unionAll(golden["ds"].labels)

    with pytest.raises(Exception, match="more than one label"):
        P.build_sequences(Twice).collect()


def test_namespaced_lookup_keeps_one_feature_per_event(golden):
    from cohortflow.operators import features as FT

    vocab = P.build_vocabulary(golden["recs"], namespaced=True)
    ds = P.build_dataset(golden["recs"], vocab)
    assert ds.features.count() == golden["ds"].features.count()
    assert FT.unknown_tokens(ds.events, vocab.table, namespaced=True).count() == 0


def test_epochs_and_linear_scores_agree(spark, golden):
    ds = golden["ds"]
    vecs = P.patient_vector_table(ds, 12)
    both = vecs.unionByName(vecs.withColumn("split", F.lit("valid")))
    fitted = ML.train_epochs(both, 12, epochs=(1, 3))
    curve = sorted((r.epoch, r.phase, r.n) for r in fitted.curve.collect())
    assert curve == [(0, "train", 3), (0, "valid", 3), (1, "train", 3), (1, "valid", 3)]
    model = ML.load_epoch(fitted, 1)
    table, intercept = ML.coefficient_table(model, spark)
    ours = {r.patient_id: r.score for r in P.scored_patients(ds, table, intercept).collect()}
    theirs = {r.patient_id: r.score for r in ML.predict(model, vecs).collect()}
    assert ours.keys() == theirs.keys() and all(abs(ours[k] - theirs[k]) < 1e-9 for k in ours)


def test_model_fit_persist_and_curve(spark, golden, tmp_path):
    ds = golden["ds"]
    vecs = P.patient_vector_table(ds, 12)
    model = ML.train_classifier(vecs, max_iter=10)
    path = str(tmp_path / "model")
    save_model(model, path)
    again = load_model(path)
    a = sorted((r.patient_id, round(r.score, 9)) for r in ML.predict(model, vecs).collect())
    b = sorted((r.patient_id, round(r.score, 9)) for r in ML.predict(again, vecs).collect())
    assert a == b and len(a) == 3
    curve = ML.learning_curve(model, spark).collect()
    assert curve and all(r.loss == r.loss for r in curve)
    ev = ML.evaluate(model, vecs).first()
    assert ev.n == 3 and 0 <= ev.accuracy <= 100


def test_mlp_variant(spark, golden):
    vecs = P.patient_vector_table(golden["ds"], 12)
    model = ML.train_classifier(vecs, width=12, kind="mlp", max_iter=5)
    assert ML.predict(model, vecs).count() == 3


def test_random_split_method_covers_cohort(spark, golden):
    cohort = golden["prep"].cohort.select("SUBJECT_ID")
    parts = C.split_cohort(cohort, (50, 30, 20), seed=7, method="random")
    assert sorted(r.SUBJECT_ID for r in parts.collect()) == ["1", "2", "4", "5"]


def test_split_weights_route_buckets(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("SUBJECT_ID"))
    counts = {r.split: r["count"] for r in C.split_cohort(df, (65, 20, 15)).groupBy("split").count().collect()}
    assert sum(counts.values()) == 4000
    assert abs(counts["train"] / 4000 - 0.65) < 0.04 and abs(counts["test"] / 4000 - 0.20) < 0.04


def test_pool_variants(golden):
    cells = S.visit_cells(golden["ds"].features)
    last = {(r.patient_id, r.feature_id): r.value for r in S.pool_sequences(cells, "last").collect()}
    assert last[(1, 11)] == 0.0 and (1, 0) not in last  # patient 1's last visit has no id 0
    mean = {(r.patient_id, r.feature_id): r.value for r in S.pool_sequences(cells, "mean").collect()}
    assert mean[(1, 11)] == 0.75 and mean[(1, 0)] == 1.0
