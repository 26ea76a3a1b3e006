"""Readers: device feeds, Parquet tables, catalog listings."""
