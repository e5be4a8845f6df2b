"""The corpus pipeline, stage by stage, on documents with planted cases."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C

WORDS = "alpha beta gamma delta house river stone green walk light paper seven north winter bread".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(150):
        text = " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 50)) for _ in range(rnd.randint(20, 90)))
        if i % 10 == 0:
            text = f'{text} token = "{rnd.getrandbits(160):040x}" end'
        rows.append((i, text.capitalize() + ".", "en", f"s{i % 5}"))
        labels.append((i, 1, 0))
    for i in range(150, 180):
        rows.append((i, "BUY!! $$$ ### NOW!! " * 10 + str(i), "en", f"s{i % 5}"))
        labels.append((i, 0, 0))
    rows += [(200 + k, rows[3 + k][1], "en", "s1") for k in range(5)]  # exact copies
    rows += [(210 + k, rows[20 + k][1] + " extra", "en", "s2") for k in range(5)]  # near copies
    rows += [(300, None, None, None), (301, "", "en", "s1"), (None, "no id but a plain sentence of words here", "en", "s3"), (5, rows[5][1], "en", "s0")]
    out = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    docs.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = C.quality_stage(spark, docs, folder)
    assert good.columns == docs.columns
    ids = {r.doc_id for r in good.select("doc_id").collect()}
    assert set(range(150)) <= ids and not ids & set(range(150, 180))
    unique = C.near_duplicate_stage(spark, good, folder)
    assert unique.columns == docs.columns
    left = [r.doc_id for r in unique.select("doc_id").collect()]
    assert len(left) == len(set(left)) and set(range(150)) <= set(left)
    assert not set(left) & {*range(200, 205), *range(210, 215)} and {None, 300} <= set(left)
    clean = C.secret_stage(spark, unique, folder)
    assert clean.columns == docs.columns and clean.count() == unique.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    for i in range(150):
        assert ("[SECRET]" in texts[i]) == (i % 10 == 0)
        if i % 10:
            assert texts[i] == before[i]
    mixed = C.mixing_stage(spark, clean, folder)
    assert mixed.columns == docs.columns and set(r.doc_id for r in mixed.collect()) <= set(left)
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2
    packed = C.packing_stage(spark, mixed, folder)
    assert packed.count() == mixed.count() and packed.filter("padded < n_tokens").count() == 0


def test_shared_ids_lose_no_group(spark, tmp_path):
    rnd = random.Random(4)
    a, b, c, d = (" ".join(rnd.choice(WORDS) + str(rnd.randint(0, 900)) for _ in range(40)) for _ in range(4))
    rows = [(5, a, "en", "x"), (9, a, "en", "x"), (5, b, "en", "x"), (3, b, "en", "x"), (7, c, "en", "x"), (7, d, "en", "x"), (7, c, "de", "y"), (8, "", "en", "x"), (8, None, "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    runs = [sorted((tuple(r) for r in C.near_duplicate_stage(spark, docs.repartition(n), str(tmp_path)).collect()), key=repr) for n in (1, 5)]
    assert runs[0] == runs[1]
    assert sorted((r[0], r[1] or "") for r in runs[0]) == sorted([(5, a), (3, b), (7, c), (7, d), (8, ""), (8, "")])


def test_stages_with_clashing_columns_long_texts_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ("_kept_id", "_kept_key", "_n", "_secrets", "_key", "_text_key", "row", "own_id", "own_key", "group", "text_key", "copy", "place", "size", "block")
    long = " ".join(f"longword{i}" for i in range(60_000))
    wide = docs.filter("doc_id < 40").unionByName(docs.limit(1).withColumn("text", F.lit(long)).withColumn("doc_id", F.lit(9000).cast("bigint")))
    for c in names:
        wide = wide.withColumn(c, F.lit(f"own {c}"))
    for k, (_, stage) in enumerate(C.STAGES):
        assert stage(spark, wide.limit(0), folder).count() == 0
        out = stage(spark, wide, folder)
        if k < 4:
            assert out.columns == wide.columns
            rows = out.collect()
            assert rows and all(r[c] == f"own {c}" for r in rows for c in names)
            assert {r.text for r in rows if r.doc_id == 9000} == {long}
        else:
            assert out.count() == wide.count() and out.filter("n_tokens = 60000").count() == 1


def test_run_and_registration(spark, folder):
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is C.run and len(C.STAGES) == 5
    out = C.run(spark, folder)
    assert out.count() > 150 and "batch" in out.columns
    key = ["doc_id", "text_key", "copy"]
    assert out.select(*key).distinct().count() == out.count()
    assert out.groupBy("bucket", "chunk", "copy", "batch", "doc_id", "text_key").count().filter("count > 1").count() == 0
    assert out.filter("copy > 1").count() > 0


def test_rest_imports_without_the_subpackage(tmp_path):
    """A copy without the llm folders and the pipeline still offers the other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/cohortflow", tmp_path / "cohortflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as E; q = E.queries(); assert 'pooled_sum' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q and set(E.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=120)
