"""Datasets of the quality dashboard. They read the check rows of a run, a few per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.columns import quoted
from starmill.plans.discovered import SEVERITY


def status_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status").agg(F.count("*").alias("size"))


def type_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check_type", "status").agg(F.count("*").alias("size"))


def coverage(checks: DataFrame, top: int = 12) -> DataFrame:
    """Checks per table and type, for the tables with most checks; 0 where there are none.

    The types of the discovered suite always have a column, any other type that occurs has one too.
    One pivot yields the matrix, its row sums rank the tables. ``checks`` is read twice, so it should
    be stored.
    """
    known = list(SEVERITY)
    # The types of checks: a few names.
    others = checks.where(~F.col("check_type").isin(known)).select("check_type").distinct()
    kinds = known + sorted(row[0] for row in others.collect())
    matrix = (
        checks.groupBy("table").pivot("check_type", kinds).agg(F.count("dq_check_name")).na.fill(0)
    )
    total = sum((quoted(kind) for kind in kinds), F.lit(0))
    return matrix.orderBy(total.desc(), "table").limit(top)


def top_failures(checks: DataFrame, top: int = 25) -> DataFrame:
    return (
        checks.where("status = 'FAIL'")
        .select("dq_check_name", "check_type", "table", "column", "failed_rows")
        .orderBy(F.desc("failed_rows"), "dq_check_name")
        .limit(top)
    )


def detail(checks: DataFrame, top: int = 60) -> DataFrame:
    """Failures first, then by failed rows."""
    return (
        checks.orderBy("status", F.desc("failed_rows"), "dq_check_name")
        .limit(top)
        .select("status", "check_type", "table", "column", "failed_rows", "dq_check_name")
    )
