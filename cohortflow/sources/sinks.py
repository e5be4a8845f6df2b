"""Sinks (K1-K5).

The default layout is one parquet data set per table, partitioned by split,
written by one job per table.  (The original's one CSV file per table would pull
every row through one task and is not offered.)
"""

from __future__ import annotations

import uuid

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.schemas import SPLIT_FILES

SPLIT_DIRS = {"train": "train", "valid": "valid", "validation": "valid", "test": "test"}


def write_prepared(tables: dict[str, DataFrame], out: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K4: ``out/<table>/split=<split>/`` for every prepared table."""
    for name, df in tables.items():
        df.write.mode(mode).partitionBy("split").format(fmt).option("header", True).save(f"{out}/{name}")


def write_split_files(tables: dict[str, DataFrame], out: str, splits=("train", "test", "valid")) -> None:
    """K4 in the layout of the split folders: ``out/<split>/<file>_<split>.csv``, headered.

    Each is a folder of part files (readers take it like a file).  Spaces around values
    are kept.
    """
    for name, df in tables.items():
        for split in splits:
            rows = df.filter(F.col("split") == split).drop("split")
            csv = rows.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            csv.csv(f"{out}/{split}/{SPLIT_FILES[name]}_{split}.csv")


def _split_dir(split: str) -> str:
    if split not in SPLIT_DIRS:
        raise ValueError(f"unknown split {split!r}; expected one of {sorted(SPLIT_DIRS)}")
    return SPLIT_DIRS[split]


def _of_split(df: DataFrame, split: str) -> DataFrame:
    """The rows of one split: filtered by the ``split`` column where there is one."""
    if "split" not in df.columns:
        return df
    names = sorted(k for k, v in SPLIT_DIRS.items() if v == _split_dir(split))
    return df.filter(F.col("split").isin(*names)).drop("split")


def write_features(features: DataFrame, labels: DataFrame, out: str, split: str, fmt: str = "parquet") -> None:
    """K2: features and labels of one split, sorted by (patient, visit time) and by patient.

    Frames that hold all splits are filtered to ``split``; frames without a
    split column are taken to hold that split alone.
    """
    d = _split_dir(split)
    feats = _of_split(features, split).select(
        F.col("patient_id").alias("patientID"),
        F.col("admit_ms").alias("admitTime"),
        F.col("feature_id").alias("featureID"),
        F.col("value").alias("featureValue"),
    )
    # Range partitioning + local sort: a global order without a single task.
    feats = feats.repartitionByRange("patientID", "admitTime").sortWithinPartitions("patientID", "admitTime")
    labs = _of_split(labels, split).select(F.col("patient_id").alias("patientID"), F.col("is_dead").alias("IS_DEAD"))
    labs = labs.repartitionByRange("patientID").sortWithinPartitions("patientID")
    feats.write.mode("overwrite").format(fmt).save(f"{out}/featureDF_{d}")
    labs.write.mode("overwrite").format(fmt).save(f"{out}/patientIDLabels_{d}")


def write_sequences(seqs: DataFrame, out: str, split: str | None = None) -> None:
    """K3: sequences, patient ids and labels in one keyed parquet data set.

    Without ``split`` the frame must have a ``split`` column and every split is
    written to its own folder; with it, only that split's rows are written.
    """
    if split is None:
        if "split" not in seqs.columns:
            raise ValueError("sequences without a split column need the split to write")
        seqs.write.mode("overwrite").partitionBy("split").parquet(f"{out}/sequences")
    else:
        _of_split(seqs, split).write.mode("overwrite").parquet(f"{out}/sequences/split={_split_dir(split)}")


def write_by_patient(df: DataFrame, out: str, name: str, buckets: int) -> None:
    """K2/K3 in a layout that keeps the patient key: ``out/<name>.b<buckets>``, bucketed and
    sorted by (split, patient_id).

    Tables written with the same number of buckets are joined and grouped by patient
    without a shuffle (``read_by_patient``).  The rows are dealt to the buckets first, so
    a bucket is one file; take buckets of a few hundred MB.
    """
    keys = ["split", "patient_id"]
    temp = f"by_patient_{uuid.uuid4().hex}"
    spark = df.sparkSession
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{out.rstrip('/')}/{name}.b{buckets}").format("parquet").saveAsTable(temp)
    spark.sql(f"DROP TABLE {temp}")  # an external table: its files stay


def save_model(model, path: str) -> None:
    """K5."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """K5: whatever model, pipeline or bundle was saved at ``path``; its class is in the metadata."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())
