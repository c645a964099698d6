"""History of discovered-suite runs: roll-up, keyed append and the latest runs."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from starmill.functions.calendar import as_utc, iso_utc, run_id
from starmill.functions.columns import literal_rows
from starmill.sources.commits import create_once
from starmill.sources.files import exists, remove
from starmill.sources.layers import Layer
from starmill.sources.scratch import written_once

RUNS = "dq_runs"
CHECKS = "dq_checks"
RUNS_SCHEMA = (
    "run_id string, run_ts timestamp_ntz, db_name string, total_checks int, failed_checks int, "
    "total_failed_rows bigint"
)
CHECKS_SCHEMA = (
    "run_id string, run_ts timestamp_ntz, status string, check_type string, table_name string, "
    "column_name string, dq_check_name string, failed_rows bigint, severity int, run_date date"
)

COMMIT_SCHEMA = "run_id string, attempt string"


def roll_up(checks: DataFrame, db_name: str) -> DataFrame:
    """One row per run time: its id, number of checks, failures and failed rows."""
    failed = F.col("status") == "FAIL"
    return (
        checks.groupBy("run_ts")
        .agg(
            F.count("*").cast("int").alias("total_checks"),
            F.count_if(failed).cast("int").alias("failed_checks"),
            F.coalesce(F.sum(F.when(failed, F.col("failed_rows"))), F.lit(0)).alias(
                "total_failed_rows"
            ),
        )
        .select(
            run_id(F.col("run_ts")).alias("run_id"),
            "run_ts",
            F.lit(db_name).alias("db_name"),
            "total_checks",
            "failed_checks",
            "total_failed_rows",
        )
    )


def pass_rate(total: Column, failed: Column) -> Column:
    """Share of checks that passed; 1.0 when there are none."""
    return F.coalesce(F.try_divide((total - failed).cast("double"), total.cast("double")), F.lit(1.0))


def kpis(checks: DataFrame) -> DataFrame:
    """The headline figures of a run; one row even without checks."""
    failed = F.col("status") == "FAIL"
    figures = checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if(failed).alias("failed_checks"),
        F.coalesce(F.sum(F.when(failed, F.col("failed_rows"))), F.lit(0)).alias("total_failed_rows"),
    )
    rate = pass_rate(F.col("total_checks"), F.col("failed_checks"))
    return figures.select(
        "*",
        rate.alias("pass_rate"),
        F.concat(F.format_number(rate * 100, 1), F.lit("%")).alias("pass_rate_text"),
    )


def _commits(history: Layer) -> str:
    """The folder of commits: a file for each run, which names the attempt that is the run."""
    return f"{history.root}/_history/commits"


def _attempt_folder(history: Layer, table: str, attempt: str) -> str:
    return f"{history.path(table)}/attempt={attempt}"


def committed_runs(history: Layer) -> DataFrame:
    """(run_id, attempt) of the runs that are complete."""
    spark, folder = history.spark, _commits(history)
    if not exists(spark, folder):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).json(folder)


def append_runs(history: Layer, checks: DataFrame, db_name: str) -> None:
    """Add the runs found in ``checks`` to both history tables; run ids already there are skipped.

    Every call writes to directories of its own attempt, first the details, then the runs' rows. A run is
    added by one small file named by its id, which holds the attempt and is created only if there is
    none: so both tables show the same attempt of a run, or none of it, whichever writers meet and
    wherever one of them stops. An attempt that came too late takes its directories away.
    """
    spark = history.spark
    # Two tables are fed from the same results; the suite behind them must run only once.
    new_checks = checks.withColumn("run_id", run_id(F.col("run_ts")))
    known = committed_runs(history).select("run_id")
    new_checks = written_once(new_checks.join(known, "run_id", "left_anti"), "new-checks")
    attempt = uuid.uuid4().hex
    details = new_checks.select(
        "run_id",
        "run_ts",
        "status",
        "check_type",
        F.col("table").alias("table_name"),
        F.col("column").alias("column_name"),
        "dq_check_name",
        "failed_rows",
        "severity",
        F.to_date("run_ts").alias("run_date"),
    )
    details.write.partitionBy("run_date", "run_id").parquet(_attempt_folder(history, CHECKS, attempt))
    rows = _attempt_folder(history, RUNS, attempt)
    roll_up(new_checks, db_name).write.partitionBy("run_id").parquet(rows)
    # One row for each run.
    added = spark.read.schema(RUNS_SCHEMA).parquet(rows).select("run_id", F.to_date("run_ts").alias("day")).collect()
    for run, day in added:
        if not create_once(spark, f"{_commits(history)}/{run}", json.dumps({"run_id": run, "attempt": attempt})):
            remove(spark, f"{_attempt_folder(history, CHECKS, attempt)}/run_date={day}/run_id={run}")
            remove(spark, f"{rows}/run_id={run}")


def _stored(history: Layer, table: str, schema: str) -> DataFrame:
    """The committed rows of a history table in the column order of its schema; empty before the first run."""
    declared = T.StructType.fromDDL(schema)
    if not exists(history.spark, history.path(table)):
        return history.spark.createDataFrame([], declared)
    written = history.spark.read.schema(f"{schema}, attempt string").parquet(history.path(table))
    return written.join(committed_runs(history), ["run_id", "attempt"], "left_semi").select(*declared.names)


def read_runs(history: Layer) -> DataFrame:
    return _stored(history, RUNS, RUNS_SCHEMA)


def read_checks(history: Layer) -> DataFrame:
    return _stored(history, CHECKS, CHECKS_SCHEMA)


def latest_runs(runs: DataFrame, k: int = 20) -> DataFrame:
    """The k latest runs, oldest first."""
    return (
        runs.select("run_ts", "failed_checks", "total_failed_rows", "total_checks")
        .orderBy(F.desc("run_ts"))
        .limit(k)
        .orderBy("run_ts")
    )


def failures_over_time(runs: DataFrame, k: int = 30) -> DataFrame:
    """The latest runs for the trend of failures; empty while there are fewer than two."""
    shown = F.count("*").over(W.partitionBy(F.lit(1)))
    return latest_runs(runs, k).withColumn("shown", shown).where("shown >= 2").drop("shown")


def log_pipeline_run(mart: Layer, run_ts: datetime, note: str) -> DataFrame:
    """Append (run_utc, note) to the pipeline's run log."""
    columns = {"run_ts": "timestamp_ntz", "note": "string"}
    row = literal_rows(mart.spark, [(as_utc(run_ts).isoformat(sep=" "), note)], columns)
    return mart.append(
        "pipeline_runs", row.select(iso_utc(F.col("run_ts")).alias("run_utc"), "note")
    )
