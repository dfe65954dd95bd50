"""Readers and writers: CSV drops, catalog tables and views, the benchmark parquet tables."""
