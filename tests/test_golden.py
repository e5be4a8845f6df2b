"""Golden outputs of the hand-made hospital fixture (FIXTURES.md 3-6)."""

from pyspark.sql import functions as F

from cohortflow.functions.text import infer_table_name
from cohortflow.operators import sequences as S
from cohortflow.plans import composite as P

DAY1 = 4159209600000  # 2101-10-20
DAY2 = 4159641600000  # 2101-10-25
DAY3 = 4165516800000  # 2102-01-01
DAY5 = 4262976000000  # 2105-02-02


def test_cohort_and_lab_maximum(golden):
    prep = golden["prep"]
    assert sorted(r.SUBJECT_ID for r in prep.cohort.collect()) == ["1", "2", "4", "5"]
    assert {r.split for r in prep.cohort.collect()} == {"train"}
    vals = sorted(r.VALUENUM for r in prep.tables["labevents"].collect())
    assert vals == [0.125, 0.25, 0.5, 1.0]  # 2, 4, 8, 16 over the maximum 16


def test_vocabulary(golden):
    v = {r.token: r.feature_id for r in golden["vocab"].table.collect()}
    assert v == {
        "401": 0, "584": 2, "E888": 3, "V30": 4, "428": 6, "aspirin": 7, "e888": 8,
        "50912": 9, "50931": 10, "ICUStayDuration": 11,
    }


def test_labels(golden):
    got = sorted((r.patient_id, r.is_dead) for r in golden["ds"].labels.collect())
    assert got == [(1, 0), (2, 1), (5, 0)]


def test_features(golden):
    got = sorted((r.patient_id, r.admit_ms, r.feature_id, r.value) for r in golden["ds"].features.collect())
    want = sorted(
        [(1, DAY1, 0, 1.0), (1, DAY1, 0, 1.0), (1, DAY1, 7, 1.0), (1, DAY1, 7, 1.0),
         (1, DAY1, 9, 0.125), (1, DAY1, 9, 0.25), (1, DAY1, 11, 1.5),
         (1, DAY2, 3, 1.0), (1, DAY2, 6, 1.0), (1, DAY2, 8, 1.0), (1, DAY2, 11, 0.0),
         (2, DAY3, 2, 1.0), (2, DAY3, 6, 1.0), (2, DAY3, 10, 0.5), (2, DAY3, 11, 0.0),
         (5, DAY5, 11, 1.0)]
    )
    assert got == want


def test_summed_cells(golden):
    cells = S.visit_cells(golden["ds"].features)
    got = sorted((r.patient_id, r.visit_index, r.feature_id, r.value) for r in cells.collect())
    assert len(got) == 13
    assert [c for c in got if c[:2] == (1, 0)] == [(1, 0, 0, 2.0), (1, 0, 7, 2.0), (1, 0, 9, 0.375), (1, 0, 11, 1.5)]
    assert [c for c in got if c[0] == 5] == [(5, 0, 11, 1.0)]


def test_sequences_and_padding(golden):
    seqs = P.build_sequences(golden["ds"])
    lengths = {r.patient_id: len(r.seq) for r in seqs.collect()}
    assert lengths == {1: 2, 2: 1, 5: 1}
    first = [r for r in seqs.collect() if r.patient_id == 1][0].seq[0]
    assert [(p.feature_id, p.value) for p in first] == [(0, 1.0), (0, 1.0), (7, 1.0), (7, 1.0), (9, 0.125), (9, 0.25), (11, 1.5)]
    summary = S.sequence_summary(seqs).select("split", "patient_id", "label", F.col("n_visits").alias("length"))
    slots = S.batch_slots(S.assign_batches(summary, 64))
    rows = sorted(slots.collect(), key=lambda r: r.position)
    assert [(r.patient_id, r.slot, r.length, r.padded_length) for r in rows] == [(1, 0, 2, 2), (2, 1, 1, 2), (5, 2, 1, 2)]
    padded = S.pad_batches(S.sequence_entries(seqs).drop("label"), slots).collect()
    assert len(padded) == 16 + 2
    assert sorted((r.patient_id, r.step, r.value) for r in padded if r.feature_id is None) == [(2, 1, 0.0), (5, 1, 0.0)]


def test_chunked_sequences_equal_whole(golden):
    feats = golden["ds"].features
    whole = S.sequence_entries(S.sequences(feats)).collect()
    chunked = S.sequence_entries(S.sequences(feats, visits_per_row=1)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, chunked))


def test_rejects(golden):
    rej = P.rejects_report(golden["prep"]).collect()
    got = sorted((r.table_name, r.subject_id, r.hadm_id, r.reason) for r in rej)
    assert got == sorted(
        [
            ("admissions", "4", "400", "bad ADMITTIME"),
            ("diagnoses", "1", "102", "missing ICD9_CODE"),
            ("diagnoses", "2", "200", "bad ICD9_CODE"),
            ("labevents", "1", "102", "bad VALUENUM"),
            ("labevents", "2", None, "missing HADM_ID"),
        ]
    )


def test_unknown_tokens(spark, golden):
    from cohortflow.operators import features as FT

    valid = {
        "admissions": spark.createDataFrame([("valid", "6", "600", "2106-01-01 10:00:00")], "split string, SUBJECT_ID string, HADM_ID string, ADMITTIME string"),
        "diagnoses": spark.createDataFrame([("valid", "6", "600", "4019"), ("valid", "6", "600", "2500")], "split string, SUBJECT_ID string, HADM_ID string, ICD9_CODE string"),
        "prescriptions": spark.createDataFrame([("valid", "6", "600", "Heparin")], "split string, SUBJECT_ID string, HADM_ID string, DRUG string"),
        "icustays": spark.createDataFrame([("valid", "6", "600", "9006", 2.5)], "split string, SUBJECT_ID string, HADM_ID string, ICUSTAY_ID string, LOS double"),
        "labevents": spark.createDataFrame([], "split string, SUBJECT_ID string, HADM_ID string, ITEMID string, VALUENUM double"),
        "patients": spark.createDataFrame([("valid", "6", 0)], "split string, SUBJECT_ID string, IS_DEAD int"),
    }
    recs = P.records(valid)
    ds = P.build_dataset(recs, golden["vocab"])
    assert golden["vocab"].width == 12
    assert sorted((r.feature_id, r.value) for r in ds.features.collect()) == [(0, 1.0), (11, 2.5)]
    unknown = FT.unknown_tokens(ds.events, golden["vocab"].table)
    assert sorted(r.token for r in unknown.collect()) == ["250", "heparin"]


def test_table_names():
    assert infer_table_name("train/patients_train.csv") == "patients_train"
    assert infer_table_name("a/b-c.csv") == "c"
    assert infer_table_name("x/y") == "y"
    assert infer_table_name("x.csv.gz") == "gz"
    assert infer_table_name("dir/") == "dir/"
    assert infer_table_name("données.csv") == "es"


def test_table_name_column(spark):
    from cohortflow.functions.text import infer_table_name_col

    df = spark.createDataFrame([("train/patients_train.csv",), ("dir/",), ("x.csv.gz",), ("données.csv",)], "p string")
    assert [r.n for r in df.select(infer_table_name_col("p").alias("n")).collect()] == ["patients_train", "dir/", "gz", "es"]


def test_load_csv_as_table_drops_ragged_rows(spark, tmp_path):
    from cohortflow.sources import load_csv_as_table, load_records_sql

    p = tmp_path / "patients_train.csv"
    p.write_text("SUBJECT_ID,IS_DEAD\n1,0\n2,1,extra\n3\n4,\n")
    df = load_csv_as_table(spark, str(p))
    assert sorted(r.SUBJECT_ID for r in spark.table("patients_train").select("SUBJECT_ID").collect()) == ["1", "4"]
    assert df.count() == 2
    kept = load_records_sql(spark, "patients_train", ["SUBJECT_ID", "IS_DEAD"]).collect()
    assert [(r.SUBJECT_ID, r.IS_DEAD) for r in kept] == [("1", "0")]


def test_functions(spark):
    from cohortflow.functions import admit_day_millis, icd9_category, jvm_trim, norm_token

    df = spark.createDataFrame(
        [("\t4280 ", " Aspirin\n", "2101-10-20 19:08:00"), ("E8889", "X", "2104-13-45"), ("   ", "", "bad")],
        "c string, d string, t string",
    )
    rows = df.select(
        icd9_category("c").alias("cat"), norm_token("d").alias("tok"), jvm_trim("c").alias("tr"), admit_day_millis("t").alias("ms")
    ).collect()
    assert [r.cat for r in rows] == ["428", "E888", None]
    assert [r.tok for r in rows] == ["aspirin", "x", ""]
    assert rows[0].tr == "4280"
    assert [r.ms for r in rows] == [DAY1, None, None]
    partial = spark.createDataFrame([("2101",), ("2101-3",), ("2101-10-20",), ("2101-1-2 x",)], "t string")
    assert [r.ms is None for r in partial.select(admit_day_millis("t").alias("ms")).collect()] == [True, True, False, False]


def test_write_and_read_back(spark, golden, tmp_path):
    from cohortflow.sources import read_features, read_labels, write_features

    out = str(tmp_path / "out")
    ds = golden["ds"]
    write_features(ds.features, ds.labels, out, "train", fmt="csv")
    back = read_features(spark, f"{out}/featureDF_train")
    assert back.count() == 16
    assert sorted(r.patient_id for r in read_labels(spark, f"{out}/patientIDLabels_train").collect()) == [1, 2, 5]
    import pytest

    with pytest.raises(ValueError):
        write_features(ds.features, ds.labels, out, "holdout")
