"""Readers and writers: driver Parquet tables, CSV ingestion, table sinks, catalog."""
