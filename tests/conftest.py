import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortflow.session import checkpoint_dir, local_session

    s = local_session(4, shuffle_partitions=4, app="cohortflow-tests")
    checkpoint_dir(s)
    yield s
    from cohortflow.session import release_tables

    release_tables()
    s.stop()


# The hand-made hospital fixture (headered CSV text per raw file).
FIXTURE_CSV = {
    "ADMISSIONS.csv": """SUBJECT_ID,HADM_ID,ADMITTIME
1,100,2101-10-20 19:08:00
1,101,2101-10-20 23:59:00
1,102,2101-10-25 01:00:00
2,200,2102-01-01 00:00:00
3,300,2103-05-05 12:00:00
4,400,2104-13-45 00:00:00
5,500,2105-02-02 08:00:00
""",
    "DIAGNOSES_ICD.csv": """SUBJECT_ID,HADM_ID,ICD9_CODE
1,100,4019
1,101,40190
1,102,E8889
1,102,"\t4280 "
1,102,
1,999,V3001
2,200,"   "
2,200,5849
3,300,0389
""",
    "ICUSTAYS.csv": """SUBJECT_ID,HADM_ID,ICUSTAY_ID,LOS
1,100,9001,1.5
1,102,9002,abc
2,200,9003,
3,300,,2.0
4,400,9004,3.0
5,500,9005,1.0
""",
    "LABEVENTS.csv": """SUBJECT_ID,HADM_ID,ITEMID,VALUENUM
1,100,50912,2.0
1,101,50912,4.0
1,102,50912,n/a
2,200,50931,8.0
2,,50931,16.0
""",
    "PATIENTS.csv": """SUBJECT_ID,DOD_HOSP
1,
2,2102-01-09
3,
4,
5,
""",
    "PRESCRIPTIONS.csv": """SUBJECT_ID,HADM_ID,DRUG
1,100," Aspirin "
1,101,ASPIRIN
1,102,e888
2,200,428
""",
}


@pytest.fixture(scope="session")
def fixture_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("hospital")
    for name, text in FIXTURE_CSV.items():
        (d / name).write_text(text)
    return str(d)


@pytest.fixture(scope="session")
def golden(spark, fixture_dir):
    """The fixture run through the pipeline with everything in one split."""
    from cohortflow.plans import composite as P
    from cohortflow.sources import read_raw_tables

    raw = read_raw_tables(spark, fixture_dir)
    prep = P.prepare(raw, weights=(100.0, 0.0, 0.0))
    recs = P.records(prep.tables)
    vocab = P.build_vocabulary(recs)
    ds = P.build_dataset(recs, vocab)
    return {"raw": raw, "prep": prep, "recs": recs, "vocab": vocab, "ds": ds}
