"""Scale mechanisms: hot patients and visits, stage tables, plans."""

import os

from pyspark.sql import functions as F

from cohortflow.operators import sequences as S

DAY = 86_400_000


def _skewed(spark, hot_visits=3000):
    # One patient holds most events (one per visit day, three features each).
    hot = spark.range(hot_visits).select(
        F.lit(1).cast("bigint").alias("patient_id"),
        (F.col("id") * DAY).alias("admit_ms"),
        F.explode(F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("feature_id"),
        F.lit(1.0).alias("value"),
    )
    cold = spark.range(2, 200).select(
        F.col("id").alias("patient_id"), F.lit(0).cast("bigint").alias("admit_ms"),
        F.lit(5).cast("bigint").alias("feature_id"), F.lit(2.0).alias("value"),
    )
    return hot.unionByName(cold)


def test_hot_patient_is_chunked_and_whole(spark):
    feats = _skewed(spark)
    seqs = S.sequences(feats, visits_per_row=100)
    stats = seqs.groupBy("patient_id").agg(F.count("*").alias("rows"), F.max(F.size("seq")).alias("widest")).collect()
    by = {r.patient_id: r for r in stats}
    assert by[1].rows == 30 and by[1].widest == 100
    assert all(r.rows == 1 for p, r in by.items() if p != 1)
    flat = S.sequence_entries(seqs).select("patient_id", "feature_id", "value")
    assert flat.exceptAll(feats.select("patient_id", "feature_id", "value")).count() == 0
    assert flat.count() == feats.count()
    summary = {r.patient_id: r for r in S.sequence_summary(seqs).collect()}
    assert summary[1].n_visits == 3000 and summary[1].n_entries == 9000 and summary[1].last_visit_size == 3


def test_visit_index_spans_chunks(spark):
    feats = _skewed(spark, hot_visits=250)
    e = S.sequence_entries(S.sequences(feats, visits_per_row=64)).filter(F.col("patient_id") == 1)
    assert sorted(r.visit_index for r in e.select("visit_index").distinct().collect()) == list(range(250))


def test_hot_visit_is_cut_into_pieces(spark):
    # One patient, one day, 100,000 events; and one ordinary visit after it.
    hot = spark.range(100_000).select(
        F.lit(1).cast("bigint").alias("patient_id"), F.lit(0).cast("bigint").alias("admit_ms"),
        (F.col("id") % 50).alias("feature_id"), (F.col("id") / 7.0).alias("value"),
    )
    later = spark.range(3).select(F.lit(1).cast("bigint").alias("patient_id"), F.lit(DAY).cast("bigint").alias("admit_ms"), F.col("id").alias("feature_id"), F.lit(1.0).alias("value"))
    feats = hot.unionByName(later)
    seqs = S.sequences(feats)
    widest = seqs.select(F.aggregate("seq", F.lit(0), lambda a, x: a + F.size(x)).alias("n")).agg(F.max("n")).first()[0]
    assert widest <= S.ENTRIES_PER_ROW + 3
    e = S.sequence_entries(seqs)
    assert e.count() == 100_003
    first = e.filter("visit_index = 0")
    assert first.agg(F.countDistinct("entry_index")).first()[0] == 100_000 and first.agg(F.max("entry_index")).first()[0] == 99_999
    row = S.sequence_summary(seqs).first()
    assert (row.n_visits, row.last_visit_size, row.n_entries) == (2, 3, 100_003)


def test_run_leaves_no_stage_table_after_stop(tmp_path):
    """In a session of its own: everything written is gone after a run and stop()."""
    import subprocess
    import sys

    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
from cohortflow.session import checkpoint_dir, materialize, stage_scope
s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', {str(tmp_path)!r}).getOrCreate()
with stage_scope(s):
    inner = materialize(s.range(5))
    assert inner.count() == 5
base = checkpoint_dir(s).replace('file:', '')
assert os.listdir(base + '/cohortflow-tables') == []
assert materialize(s.range(7)).count() == 7
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=240)
    left = [f for _, _, names in os.walk(tmp_path) for f in names if not f.endswith(".crc")]
    assert left == []


def test_cluster_without_shared_folder_is_an_error():
    import pytest

    from cohortflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Fake:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())


def test_stage_tables_live_in_checkpoint_folder(spark):
    from cohortflow.session import _WRITTEN, checkpoint_dir, materialize, release_tables

    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    df = materialize(spark.range(100).withColumn("x", F.col("id") * 2))
    path = _WRITTEN[-1][0]
    assert path.startswith(base.rstrip("/") + "/cohortflow-tables/")
    assert df.agg(F.sum("x")).first()[0] == 9900
    local = path.replace("file:", "")
    assert os.path.isdir(local)
    release_tables([path])
    assert not os.path.exists(local)
    assert all(w[0] != path for w in _WRITTEN)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_plans_without_broadcast(spark):
    """Shuffles as they would be at scale: no side is small enough to broadcast."""
    import __spark_entry__ as E

    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        q = E.queries()
        counts = {n: _exchanges(q[n](spark, E.SMOKE_DIR)) for n in ("pooled_sum", "sequence_entries", "roc_auc", "roc_curve")}
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert counts["pooled_sum"] <= 3, counts
    assert counts["sequence_entries"] <= 5, counts
    assert counts["roc_curve"] <= counts["roc_auc"] + 2, counts
