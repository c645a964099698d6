"""The discovered check suite: rules derived from the schemas of a mart."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions import schema_rules as rules
from starmill.functions.calendar import timestamp_literal
from starmill.functions.columns import literal_rows, quoted
from starmill.operators.key_profile import by_key_type, key_profile, keyed_rows, surplus_rows
from starmill.operators.references import Reference, orphan_counts
from starmill.operators.violations import stored_table_counts
from starmill.plans.declared import known_count

log = logging.getLogger(__name__)

# Severity of a failed check by type.
SEVERITY = {"nulls": 3, "duplicates": 4, "fk_missing": 5}


@dataclass(frozen=True)
class Check:
    check_type: str
    table: str
    column: str
    suffix: str
    parent: str | None = None
    parent_column: str | None = None


def discover(
    mart: Mapping[str, DataFrame],
    schema: str = "mart",
    max_columns: int | None = None,
    fact_prefixes: Sequence[str] = rules.FACT_PREFIXES,
    key_overrides: Mapping[str, str] | None = None,
    check_types: Sequence[str] = tuple(SEVERITY),
) -> list[Check]:
    """The checks that the names and columns of a mart imply; reads schemas only.

    Key-like columns must not be NULL. The first surrogate key of a table, or the column given for
    it in ``key_overrides``, must not repeat. Surrogate keys of facts must exist in the first
    dimension, by name, that has a column of the same name. All columns are checked unless
    ``max_columns`` limits them per table; the names of those left out are logged.
    """
    if not mart:
        raise ValueError(f"no tables in schema {schema}")
    checks: list[Check] = []
    for table in sorted(mart):
        for column in _limited(table, rules.key_columns(mart[table]), max_columns):
            checks.append(Check("nulls", table, column, "nulls"))
    for table in sorted(mart):
        column = (key_overrides or {}).get(table) or rules.duplicate_key(mart[table])
        if column:
            checks.append(Check("duplicates", table, column, "duplicates"))
    targets = rules.reference_targets(mart)
    for table in sorted(t for t in mart if rules.is_fact(t, fact_prefixes)):
        for column in _limited(table, rules.surrogate_keys(mart[table]), max_columns):
            if column.lower() in targets:
                parent, parent_column = targets[column.lower()]
                checks.append(Check("fk_missing", table, column, f"missing_in_{schema}.{parent}",
                                    parent, parent_column))
    chosen = [c for c in checks if c.check_type in check_types]
    if not chosen:
        raise ValueError(f"no checks follow from the tables {sorted(mart)}")
    return chosen


def _limited(table: str, columns: Sequence[str], most: int | None) -> Sequence[str]:
    if most is not None and len(columns) > most:
        log.warning("columns of %s left unchecked: %s", table, columns[most:])
    return columns[:most]


def evaluate(
    mart: Mapping[str, DataFrame], checks: Sequence[Check], run_ts: datetime, schema: str = "mart"
) -> DataFrame:
    """(run_ts, check_type, table, column, dq_check_name, status, failed_rows, severity).

    NULLs: one filtered scan per table. Duplicates: one profile over the keys of all tables
    together. References: one pass per fact (two if
    there are large dimensions). One row per check comes out, nothing is collected.
    """
    numbered = dict(enumerate(checks))
    counts = [
        *_nulls(mart, numbered),
        *_duplicates(mart, numbered),
        *_orphans(mart, numbered),
    ]
    spark = counts[0].sparkSession
    declared = literal_rows(
        spark,
        [
            (i, c.check_type, f"{schema}.{c.table}", c.column,
             f"{schema}.{c.table}__{c.column}__{c.suffix}", SEVERITY[c.check_type])
            for i, c in numbered.items()
        ],
        {"rule": "int", "check_type": "string", "table": "string", "column": "string",
         "dq_check_name": "string", "weight": "int"},
    )
    failed = known_count("dq_check_name")
    found = reduce(DataFrame.unionByName, counts)
    # One row per check: the broadcast is bounded by the number of key columns in the schemas.
    return declared.join(F.broadcast(found), "rule", "left").select(
        timestamp_literal(run_ts).alias("run_ts"),
        "check_type",
        "table",
        "column",
        "dq_check_name",
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
        failed.alias("failed_rows"),
        F.when(failed == 0, 0).otherwise(F.col("weight")).cast("int").alias("severity"),
    )


def _of_type(numbered: Mapping[int, Check], check_type: str) -> dict[int, Check]:
    return {i: c for i, c in numbered.items() if c.check_type == check_type}


def _nulls(mart: Mapping[str, DataFrame], numbered: Mapping[int, Check]) -> list[DataFrame]:
    parts = []
    wanted = _of_type(numbered, "nulls")
    for table in dict.fromkeys(c.table for c in wanted.values()):
        mine = {i: (c.column, quoted(c.column).isNull())
                for i, c in wanted.items() if c.table == table}
        parts.extend(stored_table_counts(mart[table], mine, {}))
    return parts


def _duplicates(mart: Mapping[str, DataFrame], numbered: Mapping[int, Check]) -> list[DataFrame]:
    wanted = _of_type(numbered, "duplicates")
    kinds = {}
    for i, c in wanted.items():
        own = mart[c.table].schema[c.column].dataType
        kinds[i] = rules.common_key_type(own, own)
    parts = []
    for kind, members in by_key_type(kinds):
        rows = reduce(
            DataFrame.unionByName,
            [keyed_rows(mart[wanted[i].table], {i: wanted[i].column}, kind) for i in members],
        )
        parts.append(surplus_rows(key_profile(rows.where("key IS NOT NULL")), members))
    return parts


def _orphans(mart: Mapping[str, DataFrame], numbered: Mapping[int, Check]) -> list[DataFrame]:
    parts = []
    wanted = _of_type(numbered, "fk_missing")
    for table in dict.fromkeys(c.table for c in wanted.values()):
        pointers = {
            i: Reference(c.column, mart[c.parent], c.parent_column)
            for i, c in wanted.items() if c.table == table
        }
        parts.extend(orphan_counts(mart[table], pointers))
    return parts


def discovered_suite(
    mart: Mapping[str, DataFrame], run_ts: datetime, schema: str = "mart", **options: object
) -> DataFrame:
    """Discover and evaluate in one call; ``options`` are those of :func:`discover`."""
    return evaluate(mart, discover(mart, schema, **options), run_ts, schema)
