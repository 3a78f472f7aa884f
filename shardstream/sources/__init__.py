"""Readers and writers: the parquet log, change logs and user-supplied data sources."""
