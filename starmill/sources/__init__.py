"""CSV, layered Parquet, JSON and scratch storage."""
