"""Results of the declared suite: summary, the JSON document and the rows of the report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.calendar import iso_utc, timestamp_literal
from starmill.plans.declared import CHECK_COLUMNS

DOCUMENT_SCHEMA = (
    "run_utc string, db_path string, "
    "results array<struct<check_name: string, status: string, failed_rows: bigint, "
    "threshold_failed_rows: bigint, details: string>>, "
    "summary struct<total: bigint, passed: bigint, failed: bigint>"
)


def _totals() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    ]


def summary(checks: DataFrame) -> DataFrame:
    """(total, passed, failed) of a suite."""
    return checks.agg(*_totals())


def document(checks: DataFrame, run_ts: datetime, db_path: str) -> DataFrame:
    """One nested row: run, results in the order of the suite, summary.

    The list holds one entry per rule of the suite, so its size does not depend on the data.
    """
    entries = F.array_sort(F.collect_list(F.struct("position", *CHECK_COLUMNS)))
    return checks.agg(
        F.transform(entries, lambda e: e.dropFields("position")).alias("results"), *_totals()
    ).select(
        iso_utc(timestamp_literal(run_ts)).alias("run_utc"),
        F.lit(db_path).alias("db_path"),
        "results",
        F.struct("total", "passed", "failed").alias("summary"),
    )


def write_document(checks: DataFrame, path: str, run_ts: datetime, db_path: str) -> None:
    document(checks, run_ts, db_path).write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def result_rows(stored: DataFrame) -> DataFrame:
    """The checks of a stored document, one row each."""
    return stored.select(F.inline("results"))


def report_rows(stored: DataFrame) -> DataFrame:
    """What a report shows: each check with the run and the totals of its document."""
    return stored.select("run_utc", "db_path", "summary.*", F.inline("results"))
