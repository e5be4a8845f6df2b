"""CSV front door.

Raw hospital tables arrive as headered CSV.  Every column is read as string
and cast late; at scale convert them to parquet once (``sinks.write_prepared``)
so later runs get column pruning and predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.text import infer_table_name
from cohortflow.operators.clean import to_records
from cohortflow.schemas import PREPARED_COLUMNS, RAW_COLUMNS, RAW_FILES, SPLIT_FILES


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Headered CSV, every column string, projected to the needed columns.

    ``path`` is either the file itself (``.csv``, optionally compressed) or a
    folder holding the default file name of ``table`` (e.g. ``ADMISSIONS.csv``).
    Decided from the path alone, so it works on any Hadoop file system.
    """
    cols = RAW_COLUMNS[table]
    if not path.lower().rstrip("/").endswith((".csv", ".csv.gz", ".csv.bz2")) and table in RAW_FILES:
        path = f"{path.rstrip('/')}/{RAW_FILES[table]}"
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*cols)


def read_raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: read_raw(spark, folder, t) for t in RAW_COLUMNS}


def scan_raw(spark: SparkSession, path: str, table: str, header: list[str] | None = None) -> DataFrame:
    """S1 with the schema given: no job reads the header, every file's header is checked.

    ``header``: all columns of the files in order (default: the columns the engine
    needs).  A file with another header (a missing, extra, renamed or moved column) fails
    the scan instead of shifting values.
    """
    names = header or RAW_COLUMNS[table]
    missing = [c for c in RAW_COLUMNS[table] if c not in names]
    if missing:
        raise ValueError(f"columns of {table} missing from the given header: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    # Without column pruning a header is compared as a whole, also where few columns are read.
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("columnPruning", False).csv(path)
    return df.select(*RAW_COLUMNS[table])


#: Holds a ragged row's text in a checked scan.
RAGGED = "_ragged_row"


def scan_checked(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S2 with nothing lost: every row of headered CSV files, all columns text.

    A row with too many or too few fields has its whole text in ``RAGGED``; a good row has
    null there.  Without ``columns`` the names come from the header (one small job).
    """
    if columns is None:
        columns = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RAGGED]])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAGGED)
    df = reader.option("columnPruning", False).csv(path)
    # A scan of the row's text alone is not allowed: it is read with another column, always.
    nothing = F.substring(F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")), 1, 0)
    return df.withColumn(RAGGED, F.concat(nothing, F.col(RAGGED)))


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows ``load_csv_as_table`` keeps."""
    return checked.filter(F.col(RAGGED).isNull()).drop(RAGGED)


def ragged_rejects(checked: DataFrame, table: str) -> DataFrame:
    """C6 of the read stage: (table_name, stage, split, subject_id, hadm_id, reason, record).

    ``subject_id`` is what stands in that column, if the row reaches it; ``record`` is the
    row as written.
    """
    subject = F.col("SUBJECT_ID") if "SUBJECT_ID" in checked.columns else F.lit(None).cast("string")
    nothing = F.lit(None).cast("string")
    return checked.filter(F.col(RAGGED).isNotNull()).select(
        F.lit(table).alias("table_name"), F.lit("read").alias("stage"), nothing.alias("split"), subject.alias("subject_id"),
        nothing.alias("hadm_id"), F.lit("ragged row").alias("reason"), F.col(RAGGED).alias("record"),
    )


def load_csv_as_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Headered CSV that drops ragged rows, registered as a temp view.

    ``columnPruning=false`` makes the malformed-row test see every column, so
    the kept rows do not depend on which columns a later query selects.
    """
    df = (
        spark.read.option("header", True)
        .option("mode", "DROPMALFORMED")
        .option("delimiter", ",")
        .option("columnPruning", False)
        .csv(path)
    )
    df.createOrReplaceTempView(name or infer_table_name(path))
    return df


def load_records_sql(spark: SparkSession, view: str, columns: list[str]) -> DataFrame:
    """SELECT the columns of a view where every one is present.

    One parametrised statement replaces the per-table, per-split copies:
    the view name is bound through ``IDENTIFIER``, column names are quoted.
    """
    names = ["`" + c.replace("`", "``") + "`" for c in columns]
    present = " AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in names)
    return spark.sql(f"SELECT {', '.join(names)} FROM IDENTIFIER(:view) WHERE {present}", args={"view": view})


def split_file(spark: SparkSession, folder: str, table: str, split: str) -> str:
    """The CSV file (or folder of part files) of one table and split, whichever layout has it.

    ``<split>/<file>_<split>.csv``, ``<split>/<file>/<file>_<split>.csv`` (as prepared by the
    split step) or ``<table>_<split>.csv`` in the folder itself.
    """
    base, stem = folder.rstrip("/"), SPLIT_FILES[table]
    places = [f"{base}/{split}/{stem}_{split}.csv", f"{base}/{split}/{stem}/{stem}_{split}.csv", f"{base}/{table}_{split}.csv"]
    jvm = spark.sparkContext._jvm
    for place in places:
        at = jvm.org.apache.hadoop.fs.Path(place)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return place
    raise FileNotFoundError(f"no file of {table}, split {split}: {places}")


def load_records(spark: SparkSession, folder: str, table: str, split: str | None = None) -> DataFrame:
    """S4 for one table of a folder of CSV files, as typed records.

    With a split the file is found by ``split_file``, without one it is
    ``folder/<table>.csv`` (file or folder of part files); ragged rows are dropped and the
    table's record contract applied.  The temporary view lives only here.
    """
    name = f"{table}_{split}" if split else table
    path = split_file(spark, folder, table, split) if split else f"{folder.rstrip('/')}/{name}.csv"
    df = load_csv_as_table(spark, path, name)
    try:
        kept = load_records_sql(spark, name, PREPARED_COLUMNS[table])
    finally:
        spark.catalog.dropTempView(name)
    if "split" in df.columns or split is None:
        return to_records(kept, table)
    return to_records(kept.withColumn("split", F.lit(split)), table)


__all__ = [
    "read_raw",
    "read_raw_tables",
    "load_csv_as_table",
    "load_records_sql",
    "load_records",
    "scan_raw",
    "scan_checked",
    "good_rows",
    "ragged_rejects",
    "split_file",
    "infer_table_name",
]
