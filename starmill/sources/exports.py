"""Exports of tables as Parquet and as CSV."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame

from starmill.session import side_by_side


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Comma-separated text with a header in every part file; quotes are doubled.

    With a ``compression`` such as gzip, which readers know by the files' names, a part file is read by one task.
    """
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )


def export_all(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Several stored tables in both formats, ``name.parquet`` and ``name.csv``, side by side."""
    side_by_side(
        {
            f"{table}.{form}": partial(export, df, f"{folder}/{table}.{form}")
            for table, df in tables.items()
            for form, export in (("parquet", export_parquet), ("csv", export_csv))
        }
    )


def export_all_csv(tables: Mapping[str, DataFrame], folder: str, compression: str = "none") -> None:
    """Several tables as ``name.csv`` in one folder, side by side."""
    side_by_side({t: partial(export_csv, df, f"{folder}/{t}.csv", compression) for t, df in tables.items()})
