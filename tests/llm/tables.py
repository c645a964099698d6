"""Folders of tables as the queries read them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame


def folder_of(path: Path, **tables: DataFrame) -> str:
    """A folder with a Parquet table for each given one."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
