"""Sources and sinks."""

from cohortflow.sources.csv import (
    good_rows,
    load_csv_as_table,
    load_records,
    load_records_sql,
    read_raw,
    ragged_rejects,
    read_raw_tables,
    scan_checked,
    scan_raw,
)
from cohortflow.sources.features_io import read_by_patient, read_features, read_labels, read_prepared, read_sequences
from cohortflow.sources.sinks import (
    load_model,
    save_model,
    write_by_patient,
    write_features,
    write_prepared,
    write_sequences,
    write_split_files,
)

__all__ = [
    "good_rows",
    "ragged_rejects",
    "read_by_patient",
    "scan_checked",
    "scan_raw",
    "write_by_patient",
    "write_split_files",
    "load_csv_as_table",
    "load_records",
    "load_records_sql",
    "read_raw",
    "read_raw_tables",
    "read_features",
    "read_labels",
    "read_prepared",
    "read_sequences",
    "load_model",
    "save_model",
    "write_features",
    "write_prepared",
    "write_sequences",
]
