"""Readers: XML record files, Parquet tables and the test-table adapter."""
