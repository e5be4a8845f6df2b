"""The corpus pipeline: documents in, packed training batches out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read back as the next stage's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import minhash, mixing, packing, quality, secrets
from cohortflow.session import materialize_at, release_tables


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8).

    It is the row with the smallest id, then the smallest text hash.  Rows without
    an id stay; of rows without words, one of each id and text stays.
    """
    found = minhash.grouped_rows(docs, width=5).filter("doc_id is not null")
    # Rows are told apart by id and text: an id alone may stand for several texts.
    rows = found.groupBy("group", F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(F.struct("_kept_id", "_kept_key", "_n")).alias("first")
    kept = rows.filter("group is not null").groupBy("group").agg(first).select("first.*").unionByName(rows.filter("group is null").drop("group"))
    # Each row travels as one struct, so that no column of it can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(row, F.col("doc_id").alias("own_id"), minhash.text_key().alias("own_key"))
    joined = own.join(kept, (F.col("own_id") == F.col("_kept_id")) & (F.col("own_key") == F.col("_kept_key")))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    once = joined.filter("_n = 1").select(*columns)
    repeated = joined.filter("_n > 1").groupBy("_kept_id", "_kept_key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select(*columns)
    return once.unionByName(repeated).unionByName(docs.filter("doc_id is null"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace the secrets that the forest confirms."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per time the mix takes a document, whole documents."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every row of the mix, in the mix's order; no batch
    holds two copies of a document.  (doc_id, text_key, copy) tells the rows apart."""
    return packing.pack_mixed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("secret scan", secret_stage),
    ("source mix", mixing_stage),
    ("packing", packing_stage),
]

#: Fitted models and hashed draws have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written in the shared folder and freed
    once the next one is written.  The last result reads no stage table."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs, path = materialize_at(stage(spark, docs, sf_dir))
        if before is not None:
            release_tables([before])
        before = path
    return docs
