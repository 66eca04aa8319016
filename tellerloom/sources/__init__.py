"""Readers."""

from tellerloom.sources.delimited import read_dataset, read_datasets, read_delimited
from tellerloom.sources.jdbc import Database, postgres, read_table
from tellerloom.sources.stored import read_stored

__all__ = [
    "Database", "postgres", "read_dataset", "read_datasets", "read_delimited", "read_stored",
    "read_table",
]
