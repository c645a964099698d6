"""Totals of a fact by an attribute of a dimension, without a join of the whole fact.

Joining a fact row by row with a large dimension moves the whole fact and lets one hot key fill one
task. Instead the fact is first reduced by its key, with a map-side combine, and only those partial
totals meet the dimension. Totals stay exact for any dimension: a key that occurs twice there takes
part twice, as it would in a join of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.columns import quoted
from starmill.functions.measures import Measure
from starmill.operators.lookups import is_small


def partial_totals(
    fact: DataFrame, keys: Sequence[Column], measure: Measure, *extra: Column
) -> DataFrame:
    """(keys..., n_rows, n_values, total, extra...) of the fact."""
    return fact.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count(measure.amount).alias("n_values"),
        F.sum(measure.amount).alias("total"),
        *extra,
    )


def final_totals(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partial totals added up for the final grouping."""
    return partial.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in ("n_rows", "n_values", "total")]
    )


def totals_by_attribute(
    fact: DataFrame,
    fact_key: str,
    dimension: DataFrame,
    dimension_key: str,
    attributes: dict[str, Column],
    measure: Measure,
    broadcast_bytes: int = 0,
    partial: DataFrame | None = None,
) -> DataFrame:
    """(attributes..., n_rows, n_values, total): inner join of a fact with one dimension.

    A dimension measured to take at most ``broadcast_bytes`` is broadcast to the scan of the
    fact, which then shuffles only its few attribute values; reducing by key first would shuffle
    every key of every task. Leave it at 0 for keys of a small domain, such as days or campaigns,
    where reducing first is as good and needs no count. NULL keys match nothing in an inner join, so
    they are filtered in the scan. ``partial`` are totals by ``_key`` that are at hand already.
    """
    known = fact.where(quoted(fact_key).isNotNull())
    key = quoted(fact_key).alias("_key")
    lookup = dimension.select(
        quoted(dimension_key).alias("_key"), *[c.alias(name) for name, c in attributes.items()]
    )
    if partial is None and broadcast_bytes and is_small(lookup, broadcast_bytes):
        rows = known.select(key, measure.amount.alias("_amount")).join(F.broadcast(lookup), "_key")
        amount = Measure(F.col("_amount"), measure.units)
        return partial_totals(rows, [F.col(name) for name in attributes], amount)
    if partial is None:
        partial = partial_totals(known, [key], measure)
    return final_totals(partial.join(lookup, "_key"), list(attributes))


def named_totals(
    partial: DataFrame,
    key: str,
    dimension: DataFrame,
    attributes: Sequence[str],
    broadcast_bytes: int = 0,
) -> DataFrame:
    """Partial totals left-joined to a dimension: its attributes added, totals kept exact.

    The dimension is reduced to one row per key and attributes with the number of its copies, so
    the joined rows are the final groups and need no further aggregate. Where the totals have more
    keys than the joined one, a join that is not known to be small when it is planned would shuffle
    them once more; ``broadcast_bytes`` has the dimension measured and broadcast if it takes no more.
    """
    rows = dimension.select(key, *attributes)
    lookup = rows.groupBy(key, *attributes).agg(F.count("*").alias("_copies"))
    if broadcast_bytes and is_small(rows, broadcast_bytes):
        lookup = F.broadcast(lookup)
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    joined = partial.join(lookup, key, "left")
    return joined.withColumns(
        {name: F.col(name) * copies for name in ("n_rows", "n_values", "total")}
    ).drop("_copies")
