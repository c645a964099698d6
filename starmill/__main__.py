"""Run the pipeline or single stages: ``python -m starmill --warehouse W --source CSV_FOLDER``.

Also a spark-submit application. Without ``--stage`` all stages run in order, but for the sample and those of a
growing fact. Partition
settings follow the bytes found in the sources and the warehouse.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from starmill.functions.calendar import utc_now
from starmill.plans import history, pipeline
from starmill.plans.star import FACT
from starmill.session import build_session, sizing
from starmill.sources.files import size

STAGES = ["ingest", "marts", "analytics", "checks", "dashboard"]
# For a fact that grows: new sales from the first source, and marts brought up to the fact's files.
GROWTH = ["append", "refresh"]


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starmill", description=__doc__)
    parser.add_argument("--warehouse", required=True, help="folder of the layers")
    parser.add_argument("--source", action="append", default=[],
                        help="folder of the CSV files; repeat for fallbacks, first existing wins")
    parser.add_argument("--export", help="folder for Parquet and CSV exports")
    parser.add_argument("--stage", action="append", choices=["sample", *STAGES, *GROWTH])
    parser.add_argument("--sample-to", help="folder for the light copy that --stage sample makes")
    parser.add_argument("--schema", action="append", default=[], metavar="TABLE=DDL",
                        help="columns of a CSV file, which spares the pass that infers types")
    parser.add_argument("--scale", type=int,
                        help="add doubles in whole units of that many decimal places")
    parser.add_argument("--db-name", default="warehouse")
    return parser.parse_args(given)


def schemas(given: Sequence[str]) -> dict[str, T.StructType]:
    pairs = [text.partition("=") for text in given]
    return {table: T.StructType.fromDDL(ddl) for table, _, ddl in pairs}


def fit_to_input(spark: SparkSession, folders: Sequence[str]) -> None:
    """Partition settings for a job that may shuffle all of its input once."""
    found = sum(size(spark, folder) for folder in folders)
    for key, value in sizing(found, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def main() -> None:
    args = arguments()
    spark = build_session()
    fit_to_input(spark, [*args.source, args.warehouse])
    warehouse = pipeline.Warehouse(spark, args.warehouse)
    stages = args.stage or STAGES
    run_ts = utc_now()
    columns = schemas(args.schema)
    if "sample" in stages:
        pipeline.make_sample(spark, args.source[0], args.sample_to, schemas=columns)
    if "ingest" in stages:
        pipeline.load_raw(warehouse, args.source, run_ts, schemas=columns).show(truncate=False)
    if "marts" in stages:
        pipeline.build_marts(warehouse, run_ts, args.export)
    if "analytics" in stages:
        pipeline.build_analytics(warehouse, args.export, args.scale)
    if "append" in stages:
        pipeline.append_sales(warehouse, args.source[0], columns.get(FACT))
    if "refresh" in stages:
        months, refreshed = pipeline.refresh_marts(warehouse, args.scale)
        print("months rebuilt:", ", ".join(months) or "none")
        for name, table in refreshed.items():
            table.write.mode("overwrite").parquet(warehouse.report(f"marts/{name}"))
    if "checks" in stages:
        report = pipeline.run_declared_checks(warehouse, run_ts)
        report.select("check_name", "status", "failed_rows", "details").show(100, truncate=False)
    if "dashboard" in stages:
        checks = pipeline.run_discovered_checks(warehouse, run_ts, args.db_name)
        for name, panel in pipeline.dashboard(warehouse, checks, args.scale).items():
            panel.write.mode("overwrite").parquet(warehouse.report(f"panels/{name}"))
        history.latest_runs(history.read_runs(warehouse.history)).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
