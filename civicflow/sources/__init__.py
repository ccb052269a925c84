"""Sources and sinks: testdata adapter, keyset extraction, JSON/CSV files, layered tables."""

from . import extract, files, tables, testdata

__all__ = ["extract", "files", "tables", "testdata"]
