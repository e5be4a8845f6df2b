"""Properties and plan checks over the driver tables (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import cohort as C
from cohortflow.operators import sequences as S
from cohortflow.operators.ordering import global_index, grouped_prefix_sums
from cohortflow.plans import composite as P
from cohortflow.plans.queries import Stages

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def st(spark):
    return Stages(spark, SF)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_disjoint_complete_and_partition_invariant(spark, st):
    cohort = st.prep.cohort
    assert cohort.count() == cohort.select("SUBJECT_ID").distinct().count()
    assert cohort.filter(F.col("split").isNull()).count() == 0
    again = C.split_cohort(C.icu_cohort(P.clean.fill_los(st.raw["icustays"])).repartition(7))
    a = {(r.SUBJECT_ID, r.split) for r in cohort.collect()}
    b = {(r.SUBJECT_ID, r.split) for r in again.collect()}
    assert a == b


def test_vocabulary_ids_dense_but_one_gap(st):
    sizes = {r.domain: r for r in __import__("cohortflow.operators.vocab", fromlist=["x"]).vocabulary_sizes(
        st.train("diagnoses"), st.train("prescriptions"), st.train("labevents")).collect()}
    d, m, lab, icu = sizes["diagnosis"], sizes["medication"], sizes["lab"], sizes["icu"]
    assert d.first_id == 0 and d.last_id == d.n_tokens - 1
    assert m.first_id == d.n_tokens + 1
    assert lab.first_id == m.last_id + 1
    assert icu.first_id == lab.last_id + 1


def test_flattened_sequences_equal_features(st):
    seqs = P.build_sequences(st.ds, visits_per_row=3)
    flat = S.sequence_entries(seqs).select("patient_id", "feature_id", "value")
    feats = st.ds.features.select("patient_id", "feature_id", "value")
    assert flat.exceptAll(feats).count() == 0 and feats.exceptAll(flat).count() == 0


def test_padding_adds_only_empty_visits(st):
    seqs = P.build_sequences(st.ds)
    summary = S.sequence_summary(seqs).select("split", "patient_id", F.col("n_visits").alias("length"))
    slots = S.batch_slots(S.assign_batches(summary, 8, seed=3))
    entries = S.sequence_entries(seqs).drop("label")
    padded = S.pad_batches(entries, slots)
    real = padded.filter("feature_id is not null").select("patient_id", "step", "feature_id", "value")
    want = entries.select("patient_id", F.col("visit_index").alias("step"), "feature_id", "value")
    assert real.exceptAll(want).count() == 0 and want.exceptAll(real).count() == 0
    steps = padded.groupBy("split", "batch_id", "slot").agg(F.countDistinct("step").alias("n"), F.max("padded_length").alias("p")).collect()
    assert all(r.n == r.p for r in steps)
    assert padded.filter("feature_id is null and step < length").count() == 0
    per_batch = {}
    for r in slots.collect():
        per_batch.setdefault((r.split, r.batch_id), []).append(r)
    for batch in per_batch.values():
        assert len(batch) <= 8
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
        by_slot = sorted(batch, key=lambda r: r.slot)
        assert [r.length for r in by_slot] == sorted((r.length for r in batch), reverse=True)


def test_global_index_matches_row_number(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select((F.hash("id") % 977).alias("k"), "id").repartition(5)
    got = global_index(df, [F.col("k"), F.col("id")], "gi", num_partitions=6)
    want = df.withColumn("gi", F.row_number().over(Window.orderBy("k", "id")) - 1)
    assert got.select("k", "id", "gi").exceptAll(want.select("k", "id", "gi")).count() == 0


def test_grouped_prefix_sums(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 5), ("b", 3, 1), ("a", 3, 4)], "g string, o int, v long")
    out = {(r.g, r.o): r.v_cum for r in grouped_prefix_sums(df, ["g"], [F.col("o")], ["v"], num_partitions=3).collect()}
    assert out == {("a", 1): 1, ("a", 2): 3, ("a", 3): 7, ("b", 1): 5, ("b", 3): 6}


def test_confusion_counts_sum_to_n(st):
    from cohortflow.operators import metrics as M

    s = st.scores
    total = M.confusion_matrix(s, by=["split"]).agg(F.sum("n")).first()[0]
    assert total == s.count()


def test_visit_vectors_width(st):
    vecs = S.visit_vectors(S.visit_cells(st.ds.features), st.vocab.width).collect()
    assert vecs and all(v.features.size == st.vocab.width for v in vecs)


def test_plan_vocabulary_broadcast_no_python(st):
    from cohortflow.operators import features as FT

    plan = _plan(FT.index_features(st.ds.events, st.vocab.table))
    assert "BroadcastHashJoin" in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_plan_sequences_no_single_partition(st):
    plan = _plan(P.build_sequences(st.ds, visits_per_row=64))
    assert "SinglePartition" not in plan


def test_plan_pushdown_and_pruning(spark, st):
    from cohortflow.plans import roles as R

    plan = _plan(R.role_tables(spark, SF)["patients"])
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    # Materialised stage tables are parquet scans: filters and pruning reach them.
    plan = _plan(st.ds.features.filter(F.col("split") == "train").select("patient_id", "feature_id"))
    assert "EqualTo(split,train)" in plan
    assert "ReadSchema: struct<split:string,patient_id:bigint,feature_id:bigint>" in plan


def test_model_runs_and_reports(st):
    run = P.run_model(st.ds, epochs=(2, 5))
    assert run.curve.count() == 4 and run.best in (0, 1)
    pred = run.report["predictions"]
    assert pred.count() == st.ds.labels.filter(F.col("split") == "test").count()
    assert pred.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    auc = run.report["auc"].first()
    assert auc is None or auc.auc is None or 0.0 <= auc.auc <= 1.0


def test_vocabulary_independent_of_row_order(st):
    from cohortflow.operators import vocab as V

    def shuffled(t):
        return st.train(t).repartition(5, F.rand(11))

    a = {(r.token, r.feature_id) for r in st.vocab.table.collect()}
    b = {(r.token, r.feature_id) for r in V.build_vocab(shuffled("diagnoses"), shuffled("prescriptions"), shuffled("labevents")).collect()}
    assert a == b


def test_prefix_sums_random(spark):
    import random

    from cohortflow.operators.ordering import prefix_sums

    rnd = random.Random(5)
    rows = [(i, rnd.randint(-5, 20)) for i in rnd.sample(range(10000), 600)]
    df = spark.createDataFrame(rows, "o long, v long").repartition(3)
    got = {r.o: r.v_cum for r in prefix_sums(df, [F.col("o")], ["v"], num_partitions=7).collect()}
    acc, want = 0, {}
    for o, v in sorted(rows):
        acc += v
        want[o] = acc
    assert got == want
