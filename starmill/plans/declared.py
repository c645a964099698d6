"""The declared check suite: rules as data, evaluated in as few passes as the rules allow."""

from __future__ import annotations

import logging
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.calendar import instant_literal, timestamp_literal, utc_now
from starmill.functions.columns import literal_rows, quoted
from starmill.functions.schema_rules import common_key_type, field
from starmill.operators.key_profile import by_key_type, key_profile, keyed_rows, repeated_keys
from starmill.operators.references import Reference, counts_with_references, orphan_counts
from starmill.operators.violations import stored_table_counts

log = logging.getLogger(__name__)

ROW_RULES = ("not_null", "non_negative", "not_future", "not_absurd")
CHECK_COLUMNS = ["check_name", "status", "failed_rows", "threshold_failed_rows", "details"]


@dataclass(frozen=True)
class Rule:
    """One check: a family, the table and column it reads, and how much failure it allows."""

    family: str
    table: str
    column: str | None
    check_name: str
    details: str
    threshold: int = 0
    limit: float | None = None
    parent: str | None = None
    parent_column: str | None = None
    optional: bool = False


def rowcount_floor(table: str, floor: int = 1, optional: bool = False) -> Rule:
    bare = table.rpartition(".")[2]
    details = f"{bare} should have at least {floor} row{'s' if floor > 1 else ''}"
    return Rule("rowcount_floor", table, None, f"{table}__rowcount_floor", details,
                limit=floor, optional=optional)


def not_null(table: str, column: str, details: str | None = None, optional: bool = False) -> Rule:
    return Rule("not_null", table, column, f"{table}__{column}__not_null",
                details or f"{column} should never be NULL", optional=optional)


def unique(table: str, column: str) -> Rule:
    bare = table.rpartition(".")[2]
    return Rule("unique", table, column, f"{table}__{column}__unique",
                f"{column} should be unique in {bare}")


def references(table: str, column: str, parent: str, parent_column: str) -> Rule:
    fact, dim = table.rpartition(".")[2], parent.rpartition(".")[2]
    return Rule("references", table, column,
                f"{table}__{column}_fk__references_{dim}.{parent_column}",
                f"All {column} values in {fact} should exist in {dim}.{parent_column}",
                parent=parent, parent_column=parent_column)


def non_negative(table: str, column: str, optional: bool = False) -> Rule:
    return Rule("non_negative", table, column, f"{table}__{column}__non_negative",
                f"{column} should be >= 0", optional=optional)


def not_future(table: str, column: str) -> Rule:
    return Rule("not_future", table, column, f"{table}__{column}__not_future",
                f"{column} should not be in the future (beyond 1 day)")


def not_absurd(table: str, column: str, bound: float = 1_000_000) -> Rule:
    return Rule("not_absurd", table, column, f"{table}__{column}__not_absurd",
                f"{column} should not exceed {bound:,} (sanity check)", limit=bound)


# The declared checks of the retail star, in report order.
SALES = "mart.fct_sales"
REQUIRED_COLUMNS = [
    "sales_id",
    "sales_date",
    "customer_sk",
    "product_sk",
    "store_sk",
    "salesperson_sk",
    "total_amount",
]
PARENTS = {
    "customer_sk": "mart.dim_customers",
    "product_sk": "mart.dim_products",
    "store_sk": "mart.dim_stores",
    "salesperson_sk": "mart.dim_salespersons",
    "campaign_sk": "mart.dim_campaigns",
}
RETAIL_RULES = [
    rowcount_floor("mart.dim_customers"),
    rowcount_floor(SALES),
    *[not_null(SALES, column) for column in REQUIRED_COLUMNS],
    unique(SALES, "sales_id"),
    *[references(SALES, column, parent, column) for column, parent in PARENTS.items()],
    non_negative(SALES, "total_amount"),
    not_future(SALES, "sales_date"),
    not_absurd(SALES, "total_amount"),
    rowcount_floor("analytics.mart_store_daily", optional=True),
    non_negative("analytics.mart_store_daily", "revenue", optional=True),
    not_null(
        "analytics.mart_campaign_perf",
        "campaign_name",
        "campaign_name should not be NULL (dim join should resolve)",
        optional=True,
    ),
]


def present_rules(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> list[Rule]:
    """The rules whose table exists. An optional rule without one is logged, any other raises."""
    absent = [r for r in rules if r.table not in tables]
    required = [r.check_name for r in absent if not r.optional]
    if required:
        raise KeyError(f"tables are missing for the checks {required}")
    if absent:
        log.warning("checks skipped, their tables do not exist: %s", [r.check_name for r in absent])
    return [r for r in rules if r.table in tables]


def violated(rule: Rule, kind: T.DataType, as_of: datetime | None) -> Column:
    """The predicate of a row that breaks a row-level rule. NULL breaks only ``not_null``."""
    column = quoted(rule.column)
    if rule.family == "not_null":
        return column.isNull()
    if rule.family == "non_negative":
        return column < F.lit(0).cast(kind)
    if rule.family == "not_absurd":
        return column > F.lit(rule.limit)
    latest = timestamp_literal(as_of or utc_now()) + F.expr("INTERVAL 1 DAY")
    if isinstance(kind, T.DateType):
        # A date is midnight: it is past an instant exactly when it is past the instant's day.
        return column > latest.cast("date")
    if isinstance(kind, T.TimestampType):
        return column > instant_literal(as_of or utc_now()) + F.expr("INTERVAL 1 DAY")
    return column > latest


def evaluate(
    rules: Sequence[Rule],
    tables: Mapping[str, DataFrame],
    as_of: datetime | None = None,
    derived: Collection[str] = (),
) -> DataFrame:
    """(position, check_name, status, failed_rows, threshold_failed_rows, details) per rule.

    Per table: one count for the floors, one filtered scan for all row-level rules, one pass for the
    references (two if there are large dimensions), one profile for all unique keys of a type.
    Uniqueness has a profile of its own because its keys hardly combine and would crowd out those of
    the references. Columns are found in any case. A rule given twice is counted twice.
    Tables named in ``derived`` are query results instead of stored tables; their floors, row-level
    rules and references share one pass. One row per rule comes out; nothing is collected.
    """
    rules = present_rules(rules, tables)
    if not rules:
        raise ValueError("no checks to run")
    placed = {i: _spelled(rule, tables) for i, rule in enumerate(rules)}
    counts: list[DataFrame] = []
    for table in dict.fromkeys(r.table for r in rules):
        df = tables[table]
        kinds = {f.name: f.dataType for f in df.schema.fields}
        mine = {i: r for i, r in placed.items() if r.table == table}

        floors = {i: int(r.limit) for i, r in mine.items() if r.family == "rowcount_floor"}
        row_rules = {
            i: (r.column, violated(r, kinds[r.column], as_of))
            for i, r in mine.items() if r.family in ROW_RULES
        }
        pointers = {
            i: Reference(r.column, tables[r.parent], r.parent_column)
            for i, r in mine.items() if r.family == "references"
        }
        if table in derived:
            counts.extend(counts_with_references(df, row_rules, pointers, floors))
        else:
            counts.extend(stored_table_counts(df, row_rules, floors))
            counts.extend(orphan_counts(df, pointers))
        keys = {i: r.column for i, r in mine.items() if r.family == "unique"}
        types = {i: common_key_type(kinds[c], kinds[c]) for i, c in keys.items()}
        for kind, members in by_key_type(types):
            rows = keyed_rows(df, {i: keys[i] for i in members}, kind)
            counts.append(repeated_keys(key_profile(rows), members))
    return with_status(rules, reduce(DataFrame.unionByName, counts))


def _spelled(rule: Rule, tables: Mapping[str, DataFrame]) -> Rule:
    """The rule with its columns spelled as its tables spell them."""
    if rule.column is None:
        return rule
    column = field(tables[rule.table].schema, rule.column).name
    if rule.parent is None:
        return replace(rule, column=column)
    parent_column = field(tables[rule.parent].schema, rule.parent_column).name
    return replace(rule, column=column, parent_column=parent_column)


def known_count(check_name: str) -> Column:
    """The failed rows of a check; a count that is missing raises instead of passing as 0."""
    lost = F.raise_error(F.concat(F.lit("no count for the check "), F.col(check_name)))
    return F.coalesce(F.col("failed_rows").cast("bigint"), lost.cast("bigint"))


def with_status(rules: Sequence[Rule], counts: DataFrame) -> DataFrame:
    """Counts joined to their rules: exactly one count for every rule, else an error."""
    spark = counts.sparkSession
    declared = literal_rows(
        spark,
        [(i, r.check_name, r.threshold, r.details) for i, r in enumerate(rules)],
        {"rule": "int", "check_name": "string", "threshold_failed_rows": "bigint",
         "details": "string"},
    )
    failed = known_count("check_name")
    # The counts hold one row per rule, so broadcasting them is bounded by the length of the suite.
    return declared.join(F.broadcast(counts), "rule", "left").select(
        F.col("rule").alias("position"),
        "check_name",
        F.when(failed <= F.col("threshold_failed_rows"), "PASS").otherwise("FAIL").alias("status"),
        failed.alias("failed_rows"),
        "threshold_failed_rows",
        "details",
    )


def qualified(**layers: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables of several layers by their ``layer.table`` names."""
    return {f"{layer}.{name}": df for layer, tables in layers.items() for name, df in tables.items()}
