"""Size checks that decide whether a lookup table may be broadcast."""

from __future__ import annotations

from collections.abc import Hashable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted
from starmill.functions.schema_rules import field

# What a lookup of keys and names may take in an executor.
LOOKUP_BYTES = 32 * 1024 * 1024
# What all key sets of one pass may take in an executor together.
BROADCAST_BYTES = 256 * 1024 * 1024
# An entry of a hash table of keys: the key or its length, a marker, pointers and free slots.
ENTRY_BYTES = 64


def key_set_bytes(key_sets: Mapping[Hashable, tuple[DataFrame, str]]) -> dict[Hashable, int]:
    """Upper bounds for the broadcast key columns of several tables, in one job.

    Text counts by its measured length. Other keys have a fixed width and are only counted.
    """
    if not key_sets:
        return {}
    names = list(key_sets)
    parts = []
    for i, name in enumerate(names):
        df, column = key_sets[name]
        found = field(df.schema, column)
        text = isinstance(found.dataType, T.StringType | T.BinaryType)
        length = F.coalesce(F.octet_length(quoted(found.name)), F.lit(0)) if text else F.lit(0)
        parts.append(df.select(F.lit(i).alias("i"), (length + ENTRY_BYTES).cast("bigint").alias("b")))
    summed = reduce(DataFrame.unionByName, parts).groupBy("i").agg(F.sum("b"))
    # One row per table: planning input, not data.
    sizes = {names[i]: n for i, n in summed.collect()}
    return {name: sizes.get(name, 0) for name in names}


def within_budget(sizes: Mapping[Hashable, int], budget: int) -> list[Hashable]:
    """The smallest of the sets, as many as fit into the budget together."""
    chosen, left = [], budget
    for name in sorted(sizes, key=lambda n: sizes[n]):
        if sizes[name] > left:
            break
        chosen.append(name)
        left -= sizes[name]
    return chosen


def lookup_bytes(lookup: DataFrame) -> int:
    """An upper bound for a broadcast lookup: its texts by their measured length, other columns by their width."""
    width = F.lit(ENTRY_BYTES)
    for found in lookup.schema.fields:
        text = isinstance(found.dataType, T.StringType | T.BinaryType)
        width = width + (F.coalesce(F.octet_length(quoted(found.name)), F.lit(0)) + 16 if text else F.lit(16))
    return lookup.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def is_small(lookup: DataFrame, budget: int = LOOKUP_BYTES) -> bool:
    """Whether a lookup is measured to be small enough for a broadcast.

    The measure is exact, while Spark's own estimate is far too high for a lookup that is a join.
    """
    return lookup_bytes(lookup) <= budget
