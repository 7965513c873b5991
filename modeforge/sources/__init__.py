"""Readers, writers and the scratch folder."""

from modeforge.sources.files import (
    read_csv,
    read_parquet,
    read_sample,
    write_checked,
    write_parquet,
)

__all__ = ["read_csv", "read_parquet", "read_sample", "write_checked", "write_parquet"]
