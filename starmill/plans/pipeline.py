"""The batch pipeline: ingest, curate, aggregate, validate, keep history, feed the dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.calendar import as_utc
from starmill.functions.schema_rules import is_fact
from starmill.operators.sampling import exact_sample
from starmill.operators.totals import final_totals
from starmill.plans import declared, discovered, history, marts, quality_panels, results
from starmill.plans.incremental import MonthlyTotals, retail_builds
from starmill.plans.sales_panels import daily_totals, sales_panels
from starmill.plans.star import DIMENSIONS, FACT
from starmill.sources.csv_ingest import (
    MANIFEST,
    ingest,
    ingest_summary,
    read_csv,
    require_files,
    write_ingest_summary,
)
from starmill.sources.exports import export_all, export_all_csv
from starmill.sources.layers import Layer

RAW_FACT = "fact_sales_normalized"
# Fixed value: rows kept of each fact in a sample of the files.
FACT_SAMPLE = 20_000


@dataclass(frozen=True)
class Warehouse:
    """The layers of one warehouse folder."""

    spark: SparkSession
    root: str

    @property
    def raw(self) -> Layer:
        return Layer(self.spark, self.root, "raw")

    @property
    def mart(self) -> Layer:
        return Layer(self.spark, self.root, "mart")

    @property
    def analytics(self) -> Layer:
        return Layer(self.spark, self.root, "analytics")

    @property
    def history(self) -> Layer:
        return Layer(self.spark, self.root, "main")

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def make_sample(
    spark: SparkSession,
    source: str,
    target: str,
    manifest: Sequence[str] = MANIFEST,
    n: int = FACT_SAMPLE,
    seed: int = 42,
    schemas: Mapping[str, T.StructType] | None = None,
) -> None:
    """A light copy of the CSV files: dimensions whole, facts cut to ``n`` rows, reproducibly."""
    require_files(spark, source, manifest)
    tables = {}
    for name in manifest:
        table = name.removesuffix(".csv")
        df = read_csv(spark, f"{source}/{name}", (schemas or {}).get(table))
        tables[table] = exact_sample(df, n, df.columns, seed) if is_fact(table) else df
    export_all_csv(tables, target)


def load_raw(
    warehouse: Warehouse,
    sources: Sequence[str],
    run_ts: datetime,
    manifest: Sequence[str] = MANIFEST,
    schemas: Mapping[str, T.StructType] | None = None,
) -> DataFrame:
    """CSV files into the raw layer, with the ingest summary as a JSON report."""
    folder = ingest(warehouse.raw, sources, manifest, schemas)
    summary = ingest_summary(warehouse.raw, manifest)
    write_ingest_summary(
        summary, warehouse.report("ingest_summary"), run_ts, folder, warehouse.root
    )
    return summary


def build_marts(warehouse: Warehouse, run_ts: datetime, export_to: str | None = None) -> None:
    """Dimensions as they are, the normalized fact as the canonical one, and the run log."""
    curated = {table: warehouse.raw.read(table) for table in DIMENSIONS}
    stored = warehouse.mart.replace_all({**curated, FACT: warehouse.raw.read(RAW_FACT)})
    history.log_pipeline_run(warehouse.mart, run_ts, "build_marts")
    if export_to:
        export_all(stored, export_to)


def build_analytics(
    warehouse: Warehouse, export_to: str | None = None, scale: int | None = None
) -> None:
    """The two summary marts, stored and optionally exported; see ``measure_of`` for ``scale``."""
    fact = warehouse.mart.read(FACT)
    built = {
        "mart_store_daily": marts.store_daily(fact, warehouse.mart.read("dim_stores"), scale),
        "mart_campaign_perf": marts.campaign_performance(
            fact, warehouse.mart.read("dim_campaigns"), scale
        ),
    }
    stored = warehouse.analytics.replace_all(built)
    if export_to:
        export_all(stored, export_to)


def append_sales(
    warehouse: Warehouse, source: str, schema: T.StructType | None = None
) -> DataFrame:
    """New sales from a CSV file or folder, added to the canonical fact as files of their own."""
    columns = schema or warehouse.mart.read(FACT).schema
    return warehouse.mart.append(FACT, read_csv(warehouse.spark, source, columns))


def monthly_totals(warehouse: Warehouse, scale: int | None = None) -> MonthlyTotals:
    """The stored totals by month of the canonical fact, one store for each way of adding."""
    folder = f"{warehouse.root}/monthly/{'exact' if scale is None else f'scale-{scale}'}"
    return MonthlyTotals(warehouse.spark, folder, "sales_date", retail_builds(scale))


def refresh_marts(
    warehouse: Warehouse, scale: int | None = None
) -> tuple[list[str], dict[str, DataFrame]]:
    """The months whose files changed since the last refresh, and the marts and daily totals after it.

    The marts read the stored totals; the fact is read for those months only.
    """
    fact, stored = warehouse.mart.read(FACT), monthly_totals(warehouse, scale)
    months = stored.refresh(warehouse.mart.paths(FACT))
    amount, parts = marts.amount_of(fact, scale), {n: stored.totals(n) for n in stored.builds}
    if any(part is None for part in parts.values()):
        return months, {}
    by_campaign = marts.merged_campaigns(parts["campaigns"])
    by_key = final_totals(parts["date_keys"], ["_key"])
    daily = daily_totals(warehouse.mart.tables(), amount, by_key)
    return months, {
        "mart_store_daily": marts.named_store_days(
            parts["store_days"], warehouse.mart.read("dim_stores"), amount
        ),
        "mart_campaign_perf": marts.named_campaigns(
            by_campaign, warehouse.mart.read("dim_campaigns"), amount
        ),
        "daily_totals": daily.select("date", amount.value(F.col("total")).alias("metric")),
    }


def run_declared_checks(
    warehouse: Warehouse,
    run_ts: datetime,
    rules: Sequence[declared.Rule] = tuple(declared.RETAIL_RULES),
    as_of: datetime | None = None,
) -> DataFrame:
    """The declared suite on the stored layers; returns the report rows of the JSON document."""
    tables = declared.qualified(
        mart=warehouse.mart.tables(), analytics=warehouse.analytics.tables()
    )
    path = warehouse.report("dq_results")
    checks = declared.evaluate(rules, tables, as_of or run_ts)
    results.write_document(checks, path, run_ts, warehouse.root)
    return results.report_rows(results.read_document(warehouse.spark, path))


def run_discovered_checks(warehouse: Warehouse, run_ts: datetime, db_name: str) -> DataFrame:
    """The discovered suite on the mart layer, added to the history; returns its stored rows."""
    run_ts = as_utc(run_ts)
    checks = discovered.discovered_suite(warehouse.mart.tables(), run_ts)
    history.append_runs(warehouse.history, checks, db_name)
    stored = history.read_checks(warehouse.history)
    this_run = stored.where(
        (F.col("run_date") == F.lit(run_ts.date()))
        & (F.col("run_id") == F.lit(run_ts.strftime("%Y%m%d%H%M%S%f")))
    )
    return this_run.withColumnsRenamed({"table_name": "table", "column_name": "column"})


def dashboard(
    warehouse: Warehouse, checks: DataFrame, scale: int | None = None
) -> dict[str, DataFrame]:
    """Every dataset behind the dashboard, by panel name."""
    return {
        **sales_panels(warehouse.mart.tables(), scale),
        "kpis": history.kpis(checks),
        "status": quality_panels.status_counts(checks),
        "by_type": quality_panels.type_counts(checks),
        "coverage": quality_panels.coverage(checks),
        "top_failures": quality_panels.top_failures(checks),
        "failures_over_time": history.failures_over_time(history.read_runs(warehouse.history)),
        "detail": quality_panels.detail(checks),
    }


def run_all(
    warehouse: Warehouse,
    sources: Sequence[str],
    run_ts: datetime,
    db_name: str = "warehouse",
    export_to: str | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
    scale: int | None = None,
) -> dict[str, DataFrame]:
    """All stages in order; returns the dashboard datasets."""
    load_raw(warehouse, sources, run_ts, schemas=schemas)
    build_marts(warehouse, run_ts, export_to)
    build_analytics(warehouse, export_to, scale)
    run_declared_checks(warehouse, run_ts)
    checks = run_discovered_checks(warehouse, run_ts, db_name)
    return dashboard(warehouse, checks, scale)
