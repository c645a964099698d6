"""Rows of a fact that point to no row of a dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted
from starmill.functions.schema_rules import common_key_type, field
from starmill.operators.key_profile import (
    by_key_type,
    key_profile,
    keyed_rows,
    orphan_rows,
    parent_keys,
)
from starmill.operators.lookups import BROADCAST_BYTES, key_set_bytes, within_budget
from starmill.operators.violations import Violations, derived_table_counts


@dataclass(frozen=True)
class Reference:
    """A column of the fact and the dimension column its values must exist in."""

    column: str
    parent: DataFrame
    parent_column: str

    def key_type(self, df: DataFrame) -> T.DataType:
        return common_key_type(
            field(df.schema, self.column).dataType,
            field(self.parent.schema, self.parent_column).dataType,
        )


References = Mapping[int, Reference]


def orphan_counts(
    df: DataFrame,
    references: References,
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> list[DataFrame]:
    """(by..., rule, failed_rows): rows whose key is not NULL and has no parent.

    Dimensions measured to fit into ``broadcast_bytes`` together, the smallest first, are broadcast
    into one pass over their columns of the fact, which then shuffles nothing but counts. The others
    meet the profile of their keys.
    Both passes together read each column of the fact once.
    """
    return counts_with_references(df, {}, references, {}, by, broadcast_bytes)


def counts_with_references(
    df: DataFrame,
    violations: Violations,
    references: References,
    floors: Mapping[int, int],
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> list[DataFrame]:
    """As :func:`orphan_counts`, with row-level rules and floors counted in the pass of the probes.

    A query result is thereby computed once for all of them, unless it has large dimensions.
    """
    sizes = key_set_bytes({rule: (r.parent, r.parent_column) for rule, r in references.items()})
    small = {rule: references[rule] for rule in within_budget(sizes, broadcast_bytes)}
    large = {rule: r for rule, r in references.items() if rule not in small}
    parts = []
    if small or violations or floors:
        probed, orphaned = probe(df, small)
        parts.append(derived_table_counts(probed, {**violations, **orphaned}, floors, by))
    for kind, members in by_key_type({rule: r.key_type(df) for rule, r in large.items()}):
        rows = keyed_rows(df, {i: large[i].column for i in members}, kind, by)
        parents = parent_keys({i: (large[i].parent, large[i].parent_column) for i in members}, kind)
        parts.append(orphan_rows(key_profile(rows, by), parents, members, by))
    return parts


def probe(df: DataFrame, references: References) -> tuple[DataFrame, Violations]:
    """The rows with a marker per reference, and per rule the predicate of an orphan.

    Every row is looked up in the broadcast keys of each dimension. The keys are distinct, so each
    row stays one row.
    """
    orphaned = {}
    for rule, r in references.items():
        key, found = f"_key{rule}", f"_found{rule}"
        parents = (
            r.parent.select(quoted(r.parent_column).cast(r.key_type(df)).alias(key))
            .where(F.col(key).isNotNull())
            .distinct()
            .withColumn(found, F.lit(True))
        )
        own = quoted(r.column).cast(r.key_type(df))
        df = df.withColumn(key, own).join(F.broadcast(parents), key, "left")
        orphaned[rule] = (r.column, F.col(key).isNotNull() & F.col(found).isNull())
    return df, orphaned
