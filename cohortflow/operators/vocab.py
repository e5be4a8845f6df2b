"""Feature vocabulary (P9, P10, A3, A4, W1, U3 -> C2).

Ids: tokens are numbered in alphabetical order inside their domain; the
domains follow each other in the order diagnosis, medication, lab, with one
unused id between the diagnosis and medication blocks, and the ICU-stay
feature takes the id after the last lab token.  On a token present in several
domains the later domain's id wins (lookups ignore the domain), while every
domain block keeps its full size.

All of this is one global index over (domain, token): the id of a token is
its position in that order, plus one for every domain after the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.text import ICU_TOKEN, icd9_category, norm_token
from cohortflow.operators.ordering import global_index
from cohortflow.schemas import DOMAINS

DOMAIN_RANK = {d: i for i, d in enumerate(DOMAINS)}


def domain_tokens(diagnoses: DataFrame, medications: DataFrame, labs: DataFrame) -> DataFrame:
    """A3: distinct (domain, token) of the three coded domains."""
    diag = diagnoses.select(F.lit("diagnosis").alias("domain"), icd9_category("code").alias("token"))
    med = medications.select(F.lit("medication").alias("domain"), norm_token("drug").alias("token"))
    lab = labs.select(F.lit("lab").alias("domain"), norm_token("item").alias("token"))
    rank = F.when(F.col("domain") == "diagnosis", 0).when(F.col("domain") == "medication", 1).otherwise(2)
    return (
        diag.unionByName(med)
        .unionByName(lab)
        .filter(F.col("token").isNotNull())
        .distinct()
        .withColumn("domain_rank", rank.cast("int"))
    )


def indexed_tokens(tokens: DataFrame) -> DataFrame:
    """W1 + A4: (domain, domain_rank, token, feature_id) for every domain entry."""
    idx = global_index(tokens, [F.col("domain_rank"), F.col("token")], "pos")
    feature_id = F.col("pos") + F.when(F.col("domain_rank") >= 1, F.lit(1)).otherwise(F.lit(0))
    return idx.select("domain", "domain_rank", "token", feature_id.cast("bigint").alias("feature_id"))


def icu_entry(indexed: DataFrame) -> DataFrame:
    """The constant ICU-stay entry: id = number of coded tokens + 1."""
    return indexed.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("icu").alias("domain"),
        F.lit(DOMAIN_RANK["icu"]).cast("int").alias("domain_rank"),
        F.lit(ICU_TOKEN).alias("token"),
        (F.col("n") + 1).cast("bigint").alias("feature_id"),
    )


def vocabulary_of_tokens(events: DataFrame, namespaced: bool = False) -> DataFrame:
    """C2 from event rows whose tokens are normalised already: (token, feature_id, domain)."""
    rank = F.when(F.col("domain") == "diagnosis", 0).when(F.col("domain") == "medication", 1).otherwise(2)
    coded = events.filter(F.col("token").isNotNull() & F.col("domain").isin("diagnosis", "medication", "lab"))
    indexed = indexed_tokens(coded.select("domain", "token").distinct().withColumn("domain_rank", rank.cast("int")))
    entries = indexed.unionByName(icu_entry(indexed))
    return entries.select("token", "feature_id", "domain") if namespaced else later_domain_wins(entries)


def later_domain_wins(entries: DataFrame) -> DataFrame:
    """A token in several domains keeps the id of the latest domain."""
    win = F.max_by(F.struct("feature_id", "domain"), "domain_rank")
    return entries.groupBy("token").agg(win.alias("w")).select("token", "w.feature_id", "w.domain")


def vocabulary_entries(diagnoses: DataFrame, medications: DataFrame, labs: DataFrame) -> DataFrame:
    """Every (domain, token, feature_id) before the overwrite merge."""
    indexed = indexed_tokens(domain_tokens(diagnoses, medications, labs))
    return indexed.unionByName(icu_entry(indexed))


def build_vocab(diagnoses: DataFrame, medications: DataFrame, labs: DataFrame, namespaced: bool = False) -> DataFrame:
    """(token, feature_id, domain) from the *training* records.

    U3: a token in several domains keeps the id of the latest domain.  With
    ``namespaced=True`` entries stay keyed by (domain, token) instead.
    """
    entries = vocabulary_entries(diagnoses, medications, labs)
    if namespaced:
        return entries.select("token", "feature_id", "domain")
    return later_domain_wins(entries)


def vocabulary_sizes(diagnoses: DataFrame, medications: DataFrame, labs: DataFrame) -> DataFrame:
    """A4 report: tokens per domain and the first id of each block."""
    entries = vocabulary_entries(diagnoses, medications, labs)
    return entries.groupBy("domain", "domain_rank").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
        F.min("feature_id").cast("bigint").alias("first_id"),
        F.max("feature_id").cast("bigint").alias("last_id"),
    )
