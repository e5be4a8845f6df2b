"""Registered queries of the training-data operators, one per operator.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import forest, langid, minhash, mixing, negatives, packing, pq, quality, runs, secrets, sketches, tokens, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    return forest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return pq.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.95)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of all documents."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    found = toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality posterior of every document."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return tokens.count_tokens(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.predict_languages(_table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents on two-word shingles."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of all documents with the forest's decision."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "start", "candidate", "score", "is_secret")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives of every positive of every fiftieth vector."""
    rows = negatives.usable_rows(negatives.relabelled(_table(spark, sf_dir, "embeddings")))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return runs.run_digests(_table(spark, sf_dir, "documents"))


def op13_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return sketches.edited_likeness(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_forest": op1_forest,
    "op2_pq": op2_pq,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_tokens": op6_tokens,
    "op7_mixing": op7_mixing,
    "op8_langid": op8_langid,
    "op9_minhash": op9_minhash,
    "op10_secrets": op10_secrets,
    "op11_negatives": op11_negatives,
    "op12_runs": op12_runs,
    "op13_sketches": op13_sketches,
}

ORACLE: dict[str, str] = {
    "op3_packing": packing.oracle_sql(),
    "op11_negatives": negatives.oracle_sql(),
}
