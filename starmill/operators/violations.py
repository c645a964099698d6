"""Counts of rows that break row-level rules: many rules, as few scanned bytes as possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted

# Rules by number: the column a rule reads and the predicate of a row that breaks it.
Violations = Mapping[int, tuple[str, Column]]


def stored_table_counts(
    df: DataFrame, violations: Violations, floors: Mapping[int, int]
) -> list[DataFrame]:
    """(rule, failed_rows) for a table that is scanned from Parquet.

    All predicates share one aggregate. A row only matters if it breaks some rule, so the
    disjunction of the rules filters the scan: Parquet drops every row group whose statistics (NULL
    count, minimum, maximum) rule out all of them, and a clean table costs its footers. One
    predicate that the reader cannot push would switch this off for all, so rules on zone-free
    timestamps, which Spark does not match with those statistics, get a pass over just their
    columns. Floors are a plain ``count(*)``, which reads no column either.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    unpushed = {r: v for r, v in violations.items() if isinstance(kinds[v[0]], T.TimestampNTZType)}
    pushed = {r: v for r, v in violations.items() if r not in unpushed}
    parts = [
        _one_pass(df.where(reduce(Column.__or__, [broken for _, broken in group.values()])), group)
        for group in (pushed, unpushed)
        if group
    ]
    if floors:
        parts.append(_one_pass(df, {}, floors))
    return parts


def derived_table_counts(
    df: DataFrame,
    violations: Violations,
    floors: Mapping[int, int] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by..., rule, failed_rows) for a query result: one pass, so that it is computed once.

    Every slice of ``by`` appears, also those without a violation.
    """
    return _one_pass(df, violations, floors or {}, by)


def _one_pass(
    df: DataFrame,
    violations: Violations,
    floors: Mapping[int, int] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    counts = {rule: F.count_if(broken) for rule, (_, broken) in violations.items()}
    for rule, floor in (floors or {}).items():
        counts[rule] = F.when(F.count("*") >= floor, 0).otherwise(1).cast("bigint")
    return counts_per_rule(df, counts, by)


def counts_per_rule(
    df: DataFrame, counts: Mapping[int, Column], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., rule, failed_rows): one aggregate with a column per rule, turned into rows."""
    ids = [quoted(c) for c in by]
    wide = df.groupBy(*ids).agg(*[count.alias(str(rule)) for rule, count in counts.items()])
    long = wide.unpivot(ids, [quoted(str(r)) for r in counts], "rule", "failed_rows")
    return long.select(*ids, F.col("rule").cast("int").alias("rule"), "failed_rows")
