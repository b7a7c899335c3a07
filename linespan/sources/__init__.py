"""Readers, landing, profiling and Parquet storage."""
