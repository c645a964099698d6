"""Small helpers for columns and literal relations."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its exact name, even if the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def literal_rows(
    spark: SparkSession, rows: Sequence[Sequence[object]], columns: dict[str, str]
) -> DataFrame:
    """A small relation of constants: a local relation, so its exact size is known when planning."""
    values = {name: [row[i] for row in rows] for i, name in enumerate(columns)}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    return spark.createDataFrame(pa.table(values), schema)
