"""Readers and writers: landed responses, bronze JSON lines, silver/gold parquet tables."""
