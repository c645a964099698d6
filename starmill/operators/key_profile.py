"""Key profiles: how often each key occurs. Uniqueness and reference rules read them.

Every keyed rule first becomes ``(rule, key, n)``. The count is combined on the map side, so a key
that fills a third of the table is one row per task before anything is shuffled, and what follows
(a join with the parents, a count of repeats) sees each key once.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted
from starmill.operators.violations import counts_per_rule


def keyed_rows(
    df: DataFrame, columns: Mapping[int, str], kind: T.DataType, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., rule, key): each row once per rule, from a single scan of the columns.

    The rule is a number because grouping by a number and a key is faster than by two strings.
    """
    ids = [quoted(c) for c in by]
    if len(columns) == 1:
        [(rule, column)] = columns.items()
        return df.select(*ids, F.lit(rule).alias("rule"), quoted(column).cast(kind).alias("key"))
    keys = [quoted(column).cast(kind).alias(str(rule)) for rule, column in columns.items()]
    long = df.select(*ids, *keys).unpivot(ids, [quoted(str(r)) for r in columns], "rule", "key")
    return long.select(*ids, F.col("rule").cast("int").alias("rule"), "key")


def key_profile(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rule, key, n). NULL is a key of its own."""
    return rows.groupBy(*[quoted(c) for c in by], "rule", "key").agg(F.count("*").alias("n"))


def repeated_keys(profile: DataFrame, rules: Collection[int]) -> DataFrame:
    """(rule, failed_rows): keys that occur more than once; a repeated NULL counts as one key."""
    return _totals(profile, rules, F.when(F.col("n") > 1, 1))


def surplus_rows(profile: DataFrame, rules: Collection[int]) -> DataFrame:
    """(rule, failed_rows): rows beyond the first of each key, NULL left out."""
    return _totals(profile, rules, F.when(F.col("key").isNotNull(), F.col("n") - 1))


def parent_keys(dimensions: Mapping[int, tuple[DataFrame, str]], kind: T.DataType) -> DataFrame:
    """(rule, key): the keys each reference may point to, once each.

    Repeats in a dimension would otherwise multiply the rows joined to it.
    """
    parents = [
        dim.select(F.lit(rule).alias("rule"), quoted(column).cast(kind).alias("key"))
        for rule, (dim, column) in dimensions.items()
    ]
    return reduce(DataFrame.unionByName, parents).where("key IS NOT NULL").distinct()


def orphan_rows(
    profile: DataFrame, parents: DataFrame, rules: Collection[int], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., rule, failed_rows): rows whose key is not NULL and has no parent.

    The profile is already partitioned by rule and key, so only the parents move: broadcast by
    Spark where their estimated size is below its threshold, shuffled otherwise. A left join with a
    marker instead of an anti join keeps rules without orphans in the result.
    """
    joined = profile.join(parents.withColumn("found", F.lit(True)), ["rule", "key"], "left")
    orphaned = F.col("key").isNotNull() & F.col("found").isNull()
    return _totals(joined, rules, F.when(orphaned, F.col("n")), by)


def _totals(
    df: DataFrame, rules: Collection[int], failed: Column, by: Sequence[str] = ()
) -> DataFrame:
    """One row per rule (and slice of ``by``), with 0 for a rule that has no keys at all."""
    totals = {
        rule: F.coalesce(F.sum(F.when(F.col("rule") == rule, failed)), F.lit(0)).cast("bigint")
        for rule in rules
    }
    return counts_per_rule(df, totals, by)


def by_key_type(
    kinds: Mapping[int, T.DataType],
) -> list[tuple[T.DataType, list[int]]]:
    """Rules grouped by the type of their keys: one profile each."""
    groups: dict[str, tuple[T.DataType, list[int]]] = {}
    for rule, kind in kinds.items():
        groups.setdefault(kind.simpleString(), (kind, []))[1].append(rule)
    return list(groups.values())
