"""The first k rows of a large table by several columns, without sorting the table.

A sort, a window or a limit of every task orders each task's whole split, however few rows are wanted. Here
narrow passes find a bound first. A pass takes the least value of a column in each of many disjoint groups of
rows: at least k rows lie at or below the k-th smallest of those minima, and hardly more. Rows
beyond the bound are left out by a filter, which Parquet statistics can apply to whole row groups. Where too
many rows share the bound itself, the next column bounds those, and so on. Only what is left, some
hundreds or thousands of rows, is ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted
from starmill.functions.schema_rules import field

#: So many rows are ordered without another bound.
ORDERED_ROWS = 100_000
#: Groups for each wanted row.
SPREAD = 4
#: Bytes of a text that bound it.
TEXT_BYTES = 7

BOUNDED = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType,
)


def _measured(df: DataFrame, name: str) -> Column | None:
    """What bounds a column: itself, the first bytes of a text as a number, None for other types."""
    found = field(df.schema, name)
    column = quoted(found.name)
    if isinstance(found.dataType, T.StringType):
        head = F.hex(F.substring(column.cast("binary"), 1, TEXT_BYTES))
        return F.conv(F.rpad(head, 2 * TEXT_BYTES, "0"), 16, 10).cast("long")
    # Wide decimals are no fixed-width buffer: their aggregation would sort.
    wide = isinstance(found.dataType, T.DecimalType) and found.dataType.precision > 18
    return column if isinstance(found.dataType, BOUNDED) and not wide else None


def _bound(df: DataFrame, value: Column, wanted: int, tasks: int) -> tuple[int, str | None]:
    """Number of nulls, and a value that at least ``wanted`` others do not exceed (None: too few rows to tell)."""
    slots = math.ceil(SPREAD * wanted / tasks)
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(slots))
    groups = df.select(F.spark_partition_id().alias("task"), slot.alias("slot"), value.alias("v"))
    least = groups.groupBy("task", "slot").agg(F.min("v").alias("least"), F.count_if(F.col("v").isNull()).alias("nulls"))
    nulls = least.agg(F.sum("nulls")).first()[0] or 0
    if nulls >= wanted:
        return nulls, None
    smallest = least.where("least IS NOT NULL").orderBy("least").limit(wanted - nulls)
    found = smallest.agg(F.count("*"), F.max("least").cast("string")).first()
    return nulls, found[1] if found[0] == wanted - nulls else None


def bounded(df: DataFrame, order_by: Sequence[str], k: int) -> DataFrame:
    """A part of the rows that holds the first ``k`` by ``order_by`` (ascending, nulls first)."""
    # Rows that surely are among the first, and those whose place the next columns tell.
    parts: list[Column] = []
    tied, left = F.lit(True), k
    # Reads no column.
    tasks = max(1, df.select(F.spark_partition_id()).distinct().count())
    for name in order_by:
        value = _measured(df, name)
        if value is None:
            break
        scope = df.where(tied)
        nulls, text = _bound(scope, value, left, tasks)
        if nulls >= left:
            tied = tied & value.isNull()
            if nulls <= ORDERED_ROWS:
                break
            continue
        if text is None:
            break
        kind = field(df.schema, name).dataType
        is_text = isinstance(kind, T.StringType)
        bound = F.lit(text).cast("bigint" if is_text else kind)
        below, equal = scope.agg(F.count_if(value < bound), F.count_if(value == bound)).first()
        parts.append(tied & ((value < bound) | value.isNull()))
        left -= nulls + below
        if left <= 0:
            return df.where(reduce(Column.__or__, parts))
        tied = tied & (value == bound)
        # Texts with the same first bytes may still differ in this column.
        if equal <= ORDERED_ROWS or is_text:
            break
    return df.where(reduce(Column.__or__, parts, tied))


def first_rows(df: DataFrame, order_by: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows by ``order_by`` (ascending, nulls first), in that order."""
    return bounded(df, order_by, k).orderBy(*[quoted(c) for c in order_by]).limit(k)
