"""Readers for stage outputs (S5, S6): whole-folder scans, never file lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.schemas import FEATURES_SCHEMA, LABELS_SCHEMA, PREPARED_COLUMNS


def _names(spark: SparkSession, path: str) -> list[str]:
    """File names in a folder, through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(p)]


def _fmt(spark: SparkSession, path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    return "csv" if any(n.endswith(".csv") for n in _names(spark, path)) else "parquet"


def read_features(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Every part file of a features folder -> (patient_id, admit_ms, feature_id, value)."""
    if _fmt(spark, path, fmt) == "csv":
        df = spark.read.schema(FEATURES_SCHEMA).option("header", False).csv(path)
    else:
        df = spark.read.parquet(path)
    return df.select(
        F.col("patientID").cast("bigint").alias("patient_id"),
        F.col("admitTime").cast("bigint").alias("admit_ms"),
        F.col("featureID").cast("bigint").alias("feature_id"),
        F.col("featureValue").cast("double").alias("value"),
    )


def read_labels(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Labels folder -> (patient_id, is_dead); headerless, so no row is lost."""
    if _fmt(spark, path, fmt) == "csv":
        df = spark.read.schema(LABELS_SCHEMA).option("header", False).csv(path)
    else:
        df = spark.read.parquet(path)
    return df.select(
        F.col("patientID").cast("bigint").alias("patient_id"),
        F.col("IS_DEAD").cast("int").alias("is_dead"),
    )


def read_sequences(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Sequences with their ids and labels, aligned by key (one parquet)."""
    df = spark.read.parquet(path)
    if split is not None and "split" in df.columns:
        df = df.filter(F.col("split") == split)
    return df


def read_prepared(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The prepared tables written by ``write_prepared``: prepared columns plus ``split``.

    The split comes back from the folder names; numbers of a CSV layout are
    cast to the types ``prepare`` yields.
    """
    out = {}
    for table, columns in PREPARED_COLUMNS.items():
        df = spark.read.option("header", True).option("inferSchema", False).format(fmt).load(f"{folder.rstrip('/')}/{table}")
        kinds = {"LOS": "double", "VALUENUM": "double", "IS_DEAD": "int"}
        out[table] = df.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in columns], F.col("split").cast("string").alias("split"))
    return out


def read_by_patient(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of ``write_by_patient``, with its buckets known to the planner.

    The number of buckets is in the folder's name, the columns in the files; the table
    stays in the session's catalog under a name of its own.
    """
    found = [n for n in _names(spark, folder) if n.startswith(f"{name}.b")]
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} layouts of {name} in {folder}")
    path = f"{folder.rstrip('/')}/{found[0]}"
    buckets = int(found[0].rsplit(".b", 1)[1])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    table = f"by_patient_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (split, patient_id) SORTED BY (split, patient_id) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)
