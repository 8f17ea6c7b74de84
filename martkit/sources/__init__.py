"""Readers, writers and schema contracts."""

from martkit.sources.contracts import MART_SCHEMAS, conform
from martkit.sources.files import copy_datasets, csv_to_parquet, read_csv, read_parquet, write_csv, write_parquet
from martkit.sources.jdbc import jdbc_options, read_jdbc, write_jdbc
from martkit.sources.records import ingest_csv, split_csv
from martkit.sources.snapshots import read_snapshot, upsert_into, vacuum, write_snapshot
from martkit.sources.tables import read_table, write_table

__all__ = [
    "MART_SCHEMAS",
    "conform",
    "copy_datasets",
    "csv_to_parquet",
    "ingest_csv",
    "jdbc_options",
    "read_csv",
    "read_jdbc",
    "read_parquet",
    "read_snapshot",
    "read_table",
    "split_csv",
    "upsert_into",
    "vacuum",
    "write_csv",
    "write_jdbc",
    "write_parquet",
    "write_snapshot",
    "write_table",
]
