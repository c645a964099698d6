"""One entry per registered query: ``(spark, folder of the given tables) -> DataFrame``.

Queries that read the fact once run on the lazy star views. Suites and layered jobs read it several
times, so they stage the star first (see ``plans.star.staged_star``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import literal_rows
from starmill.functions.measures import MONEY_SCALE
from starmill.functions.schema_rules import surrogate_keys
from starmill.operators.lookups import is_small
from starmill.operators.references import Reference, counts_with_references
from starmill.operators.sampling import exact_sample
from starmill.plans import declared, discovered, history, marts, quality_panels, results
from starmill.plans import sales_panels as panels
from starmill.plans.pipeline import RAW_FACT, Warehouse, build_marts, refresh_marts
from starmill.plans.star import (
    DERIVED_DIMENSIONS,
    DIMENSIONS,
    FACT,
    StarViews,
    given_table,
    staged_star,
)
from starmill.session import fresh_path
from starmill.sources.bucketed import KeyProfile, orphans
from starmill.sources.csv_ingest import MANIFEST, ingest, ingest_summary, read_csv
from starmill.sources.exports import export_all_csv, export_csv, export_parquet
from starmill.sources.layers import Layer
from starmill.sources.scratch import written_once

AS_OF = datetime(2001, 6, 1)
RUN_TS = datetime(2026, 1, 1)
DB_NAME = "warehouse"
SAMPLE_ROWS = 2000
HISTORY_K = 5
SECOND_BATCH = "2001-06-15"
KEY_BUCKETS = 8
HISTORY_BOUND = 100_000

Query = Callable[[SparkSession, str], DataFrame]


def analytics_views(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "mart_store_daily": marts.store_daily(star[FACT], star["dim_stores"], MONEY_SCALE),
        "mart_campaign_perf": marts.campaign_performance(
            star[FACT], star["dim_campaigns"], MONEY_SCALE
        ),
    }


# --- sources, sinks, layers -------------------------------------------------------------------


def star_csv(
    spark: SparkSession, folder: str, label: str
) -> tuple[str, dict[str, T.StructType]]:
    """The star as CSV files under the names an ingest run expects, and the schemas of its facts.

    Both facts are read from one join, stored; stores are named without moving it, if they are few enough.
    """
    star = staged_star(spark, folder, label, [FACT])
    stores = star["dim_stores"].select("store_sk", "store_name")
    if is_small(stores):
        stores = F.broadcast(stores)
    target = fresh_path(spark, label)
    tables = {table: star[table] for table in DIMENSIONS}
    tables["fact_sales_normalized"] = star[FACT]
    tables["fact_sales_denormalized"] = star[FACT].join(stores, "store_sk", "left")
    export_all_csv(tables, target, compression="gzip")
    return target, {table: df.schema for table, df in tables.items() if table.startswith("fact_")}


def fct_sales(spark: SparkSession, folder: str) -> DataFrame:
    return StarViews(spark, folder)[FACT]


def curate_dims(spark: SparkSession, folder: str) -> DataFrame:
    """Every dimension copied from one layer to the next: its rows there, and the numbers and text
    lengths in them added up."""
    star = StarViews(spark, folder)
    mart = Layer(spark, fresh_path(spark, "curate"), "mart")
    stored = mart.replace_all({table: star[table].select("*") for table in DIMENSIONS})
    counts = [
        df.agg(F.count("*").alias("n"), *content_sums(df)).select(
            F.lit(table).alias("dim"), "n", "keys", "letters"
        )
        for table, df in stored.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def content_sums(df: DataFrame) -> list[Column]:
    """(keys, letters): the sum of the surrogate key and the length of all texts."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    letters = sum((F.sum(F.length(name)) for name in texts), F.lit(0).cast("bigint"))
    return [F.sum(surrogate_keys(df)[0]).alias("keys"), letters.alias("letters")]


def ingest_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and nations out to CSV, in through the ingest job with inferred types, joined."""
    source = fresh_path(spark, "csv-source")
    manifest = ["orders.csv", "nation.csv", "customer.csv"]
    names = [name.removesuffix(".csv") for name in manifest]
    export_all_csv({table: given_table(spark, folder, table) for table in names}, source)
    raw = Layer(spark, fresh_path(spark, "csv-raw"), "raw")
    ingest(raw, [f"{source}/absent", source], manifest)
    customer, nation = raw.read("customer"), raw.read("nation")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return raw.read("orders").join(named, F.col("o_custkey") == F.col("c_custkey"))


def ingest_summary_query(spark: SparkSession, folder: str) -> DataFrame:
    """The whole star through the ingest job under its manifest of eight files."""
    source, schemas = star_csv(spark, folder, "ingest")
    raw = Layer(spark, fresh_path(spark, "ingest-raw"), "raw")
    ingest(raw, [source], MANIFEST, schemas)
    return ingest_summary(raw, MANIFEST)


def export_parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "export") + "/mart_store_daily.parquet"
    export_parquet(analytics_views(StarViews(spark, folder))["mart_store_daily"], path)
    return spark.read.parquet(path)


def export_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "export") + "/mart_campaign_perf.csv"
    mart = analytics_views(StarViews(spark, folder))["mart_campaign_perf"]
    export_csv(mart, path)
    return read_csv(spark, path, mart.schema)


def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The curation job on the whole star, which ends by writing its line to the run log.

    The line is returned with the sales and the customers found in the tables the job left.
    """
    warehouse = Warehouse(spark, fresh_path(spark, "warehouse"))
    star = StarViews(spark, folder)
    warehouse.raw.replace_all({RAW_FACT if t == FACT else t: view for t, view in star.items()})
    build_marts(warehouse, RUN_TS)
    curated = {"n_sales": FACT, "n_customers": "dim_customers"}
    counts = {
        name: warehouse.mart.read(table).agg(F.count("*")).scalar()
        for name, table in curated.items()
    }
    return warehouse.mart.read("pipeline_runs").withColumns(counts)


def sample_fact_exact(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return exact_sample(given_table(spark, folder, "lineitem"), SAMPLE_ROWS, keys, seed=42)


# --- marts ------------------------------------------------------------------------------------


def mart_store_daily(spark: SparkSession, folder: str) -> DataFrame:
    return analytics_views(StarViews(spark, folder))["mart_store_daily"]


def mart_campaign_perf(spark: SparkSession, folder: str) -> DataFrame:
    return analytics_views(StarViews(spark, folder))["mart_campaign_perf"]


def mart_store_daily_discount(spark: SparkSession, folder: str) -> DataFrame:
    """The store mart over the discount granted, a measure finer than a cent, added as doubles.

    Only the totals are rounded, to the four places that a price times a discount has.
    """
    discount = F.col("l_extendedprice") * F.col("l_discount")
    fact = given_table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("SALES_DATE"),
        F.col("l_suppkey").alias("STORE_SK"),
        discount.alias("Total_Amount"),
    )
    mart = marts.store_daily(fact, StarViews(spark, folder)["dim_stores"])
    return mart.withColumn("revenue", F.round("revenue", 4)).withColumn(
        "avg_order_value", F.col("revenue") / F.col("transactions")
    )


# --- declared suite ---------------------------------------------------------------------------

SALES = declared.SALES
REFERENCE_RULES = [r for r in declared.RETAIL_RULES if r.family == "references"]


def named(rule: declared.Rule, suffix: str) -> declared.Rule:
    """The same rule under a name of its own, for a second bound in one result."""
    return replace(rule, check_name=f"{rule.check_name}_{suffix}")


# Rule families on their own, with the declared instances and some that find failures.
FAMILIES: dict[str, list[declared.Rule]] = {
    "dq_rowcount_floor": [
        declared.rowcount_floor("mart.dim_customers"),
        declared.rowcount_floor(SALES),
        declared.rowcount_floor("analytics.mart_store_daily"),
        declared.rowcount_floor("mart.dim_campaigns", floor=4),
    ],
    "dq_not_null": [declared.not_null(SALES, c) for c in [*declared.REQUIRED_COLUMNS, "campaign_sk"]],
    "dq_unique": [declared.unique(SALES, "sales_id"), declared.unique(SALES, "campaign_sk")],
    "dq_fk": REFERENCE_RULES,
    "dq_non_negative": [
        declared.non_negative(SALES, "total_amount"),
        declared.non_negative("mart.dim_customers", "balance"),
        declared.non_negative("analytics.mart_store_daily", "revenue"),
    ],
    "dq_not_future": [declared.not_future(SALES, "sales_date")],
    "dq_not_absurd": [
        declared.not_absurd(SALES, "total_amount"),
        named(declared.not_absurd(SALES, "total_amount", HISTORY_BOUND), str(HISTORY_BOUND)),
    ],
    "dq_campaign_name_not_null": [declared.RETAIL_RULES[-1]],
}


# Views that a family reads more than once, written once before.
STAGED = {
    "dq_rowcount_floor": [FACT],
    "dq_non_negative": [FACT],
    "dq_fk": DERIVED_DIMENSIONS,
}


def rule_family(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rules = FAMILIES[name]
        star = staged_star(spark, folder, name, STAGED.get(name, []))
        summaries = analytics_views(star) if any("analytics." in r.table for r in rules) else {}
        tables = declared.qualified(mart=star, analytics=summaries)
        views = [t for t in tables if t.rpartition(".")[2] not in STAGED.get(name, [])]
        checks = declared.evaluate(rules, tables, AS_OF, derived=views)
        return checks.select(*declared.CHECK_COLUMNS)

    return run


def dq_any_case(spark: SparkSession, folder: str) -> DataFrame:
    """Rules whose names differ in case from those of the tables, one of them given twice."""
    star = staged_star(spark, folder, "any-case", [])
    rules = [
        declared.not_null(SALES, "Campaign_SK"),
        declared.unique(SALES, "Sales_ID"),
        declared.references(SALES, "CAMPAIGN_SK", "mart.dim_campaigns", "Campaign_sk"),
        declared.not_null(SALES, "Campaign_SK"),
    ]
    tables = declared.qualified(mart=star)
    return declared.evaluate(rules, tables, AS_OF, derived=tables).select(*declared.CHECK_COLUMNS)


def declared_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The declared suite on the staged star and the summary marts derived from it."""
    star = staged_star(spark, folder, "declared")
    summaries = declared.qualified(analytics=analytics_views(star))
    tables = {**declared.qualified(mart=star), **summaries}
    return declared.evaluate(declared.RETAIL_RULES, tables, AS_OF, derived=summaries)


def dq_suite_declared(spark: SparkSession, folder: str) -> DataFrame:
    return declared_checks(spark, folder).select(*declared.CHECK_COLUMNS)


def dq_suite_summary(spark: SparkSession, folder: str) -> DataFrame:
    return results.summary(declared_checks(spark, folder))


def stored_document(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "dq-results")
    results.write_document(declared_checks(spark, folder), path, RUN_TS, DB_NAME)
    return results.read_document(spark, path)


def dq_results_json(spark: SparkSession, folder: str) -> DataFrame:
    return results.result_rows(stored_document(spark, folder))


def dq_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    return results.report_rows(stored_document(spark, folder))


# --- discovered suite, history and its panels ---------------------------------------------------


def discovered_checks(spark: SparkSession, folder: str) -> DataFrame:
    return discovered.discovered_suite(staged_star(spark, folder, "discovered"), RUN_TS)


def discovered_part(check_type: str) -> Query:
    """One type of check reads the fact once, so the fact stays a view.

    References read their dimensions twice, to count and to broadcast them.
    """
    stored = DERIVED_DIMENSIONS if check_type == "fk_missing" else []
    return lambda spark, folder: discovered.discovered_suite(
        staged_star(spark, folder, check_type, stored), RUN_TS, check_types=(check_type,)
    )


def quality_panel(panel: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: panel(discovered_checks(spark, folder))


def dq_run_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """One run through the history tables, appended twice: the second append finds it there."""
    main = Layer(spark, fresh_path(spark, "history"), "main")
    history.append_runs(main, discovered_checks(spark, folder), DB_NAME)
    stored = history.read_checks(main).withColumnsRenamed(
        {"table_name": "table", "column_name": "column"}
    )
    history.append_runs(main, stored.drop("run_id", "run_date"), DB_NAME)
    return history.read_runs(main).withColumn(
        "pass_rate", history.pass_rate(F.col("total_checks"), F.col("failed_checks"))
    )


def yearly_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One run per ship year: three checks on that year's sales, with the year as grouping key."""
    star = staged_star(spark, folder, "yearly", ["dim_campaigns"])
    fact = star[FACT].withColumn("year", F.year("sales_date"))
    row_rules = {
        0: ("campaign_sk", F.col("campaign_sk").isNull()),
        2: ("total_amount", F.col("total_amount") > HISTORY_BOUND),
    }
    pointers = {1: Reference("campaign_sk", star["dim_campaigns"], "campaign_sk")}
    counts = reduce(
        DataFrame.unionByName, counts_with_references(fact, row_rules, pointers, {}, ["year"])
    )
    described = literal_rows(
        spark,
        [
            (0, "nulls", "campaign_sk", "mart.fct_sales__campaign_sk__nulls", 3),
            (1, "fk_missing", "campaign_sk",
             "mart.fct_sales__campaign_sk__missing_in_mart.dim_campaigns", 5),
            (2, "bound", "total_amount", "mart.fct_sales__total_amount__not_absurd", 4),
        ],
        {"rule": "int", "check_type": "string", "column": "string", "dq_check_name": "string",
         "weight": "int"},
    )
    failed = F.col("failed_rows") > 0
    return counts.join(F.broadcast(described), "rule").select(
        F.make_timestamp_ntz(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        .alias("run_ts"),
        "check_type",
        F.lit("mart.fct_sales").alias("table"),
        "column",
        "dq_check_name",
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        F.col("failed_rows").cast("bigint").alias("failed_rows"),
        F.when(failed, F.col("weight")).otherwise(0).cast("int").alias("severity"),
    )


def dq_history_last_k(spark: SparkSession, folder: str) -> DataFrame:
    main = Layer(spark, fresh_path(spark, "history"), "main")
    history.append_runs(main, yearly_checks(spark, folder), DB_NAME)
    return history.latest_runs(history.read_runs(main), HISTORY_K)


def history_failures(spark: SparkSession, folder: str) -> DataFrame:
    """The trend of failures over the stored yearly runs."""
    main = Layer(spark, fresh_path(spark, "history"), "main")
    history.append_runs(main, yearly_checks(spark, folder), DB_NAME)
    return history.failures_over_time(history.read_runs(main))


def coverage_of(checks: Query) -> Query:
    return lambda spark, folder: quality_panels.coverage(
        written_once(checks(spark, folder), "coverage")
    )


# --- business panels ----------------------------------------------------------------------------


def sales_panel(panel: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: panel(StarViews(spark, folder), scale=MONEY_SCALE)


def trend_by_day_number(spark: SparkSession, folder: str) -> DataFrame:
    """The trend over a calendar without a date column: its keys are read as YYYYMMDD."""
    star = StarViews(spark, folder)
    keys_only = {**star, "dim_dates": star["dim_dates"].select("date_sk")}
    return panels.sales_trend(keys_only, MONEY_SCALE)


def stored_key_references(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans of every reference of the fact, from profiles of keys that were stored in buckets beforehand."""
    star, base = StarViews(spark, folder), fresh_path(spark, "key-profiles")
    older = F.col("sales_date") < F.lit(SECOND_BATCH).cast("timestamp_ntz")
    sales = written_once(star[FACT].select("sales_date", *declared.PARENTS), "sales-keys")
    parts = []
    for column, dimension in declared.PARENTS.items():
        fact, parents = (KeyProfile(spark, f"{base}/{side}/{column}") for side in ("fact", "dimension"))
        for batch in (sales.where(older), sales.where(~older)):
            fact.add(batch, column, buckets=KEY_BUCKETS)
        parents.add(star[dimension.removeprefix("mart.")], column, buckets=KEY_BUCKETS)
        parts.append(orphans(fact, parents).select(F.lit(column).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def monthly(name: str) -> Query:
    """A mart or series of stored monthly totals: of the older sales, then refreshed for the newer ones.

    The newer sales are files of their own, so the second refresh reads and writes their months only.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        star = StarViews(spark, folder)
        warehouse = Warehouse(spark, fresh_path(spark, "monthly"))
        older = F.col("sales_date") < F.lit(SECOND_BATCH).cast("timestamp_ntz")
        dimensions = {t: star[t] for t in ("dim_stores", "dim_campaigns", "dim_dates")}
        warehouse.mart.replace_all({**dimensions, FACT: star[FACT].where(older)})
        refresh_marts(warehouse, MONEY_SCALE)
        warehouse.mart.append(FACT, star[FACT].where(~older))
        return refresh_marts(warehouse, MONEY_SCALE)[1][name]

    return query


def undated(star: Mapping[str, DataFrame]) -> DataFrame:
    """The synthetic series of the star, in the order its sales happened."""
    order = ["sales_date", "sales_id", "product_sk", "store_sk", "total_amount"]
    # The bound of the first rows takes several passes, each of which would join the given tables again.
    sales = written_once(star[FACT].select(*order), "undated-sales")
    return panels.synthetic_trend(sales, order)


QUERIES: dict[str, Query] = {
    "fct_sales": fct_sales,
    "curate_dims": curate_dims,
    "ingest_csv_roundtrip": ingest_csv_roundtrip,
    "ingest_summary": ingest_summary_query,
    "export_parquet_roundtrip": export_parquet_roundtrip,
    "export_csv_roundtrip": export_csv_roundtrip,
    "pipeline_runs": pipeline_runs,
    "sample_fact_exact": sample_fact_exact,
    "mart_store_daily": mart_store_daily,
    "mart_campaign_perf": mart_campaign_perf,
    "mart_store_daily_discount": mart_store_daily_discount,
    **{name: rule_family(name) for name in FAMILIES},
    "dq_any_case": dq_any_case,
    "dq_suite_declared": dq_suite_declared,
    "dq_suite_summary": dq_suite_summary,
    "dq_results_json": dq_results_json,
    "dq_report_rows": dq_report_rows,
    "dq_auto_nulls": discovered_part("nulls"),
    "dq_auto_duplicates": discovered_part("duplicates"),
    "dq_auto_fk": discovered_part("fk_missing"),
    "dq_suite_auto": discovered_checks,
    "dq_run_rollup": dq_run_rollup,
    "dq_history_last_k": dq_history_last_k,
    "panel_failures_over_time": history_failures,
    "panel_kpis": quality_panel(history.kpis),
    "panel_status": quality_panel(quality_panels.status_counts),
    "panel_by_type": quality_panel(quality_panels.type_counts),
    "panel_coverage": coverage_of(discovered_checks),
    "panel_coverage_yearly": coverage_of(yearly_checks),
    "panel_top_failures": quality_panel(quality_panels.top_failures),
    "panel_detail": quality_panel(quality_panels.detail),
    "panel_trend": sales_panel(panels.sales_trend),
    "panel_heatmap": sales_panel(panels.seasonality),
    "panel_heatmap_pivot": sales_panel(
        lambda s, scale: panels.seasonality_matrix(panels.seasonality(s, scale))
    ),
    "dq_fk_stored_keys": stored_key_references,
    "mart_store_daily_monthly": monthly("mart_store_daily"),
    "mart_campaign_perf_monthly": monthly("mart_campaign_perf"),
    "panel_trend_monthly": monthly("daily_totals"),
    "panel_trend_by_day_number": trend_by_day_number,
    "panel_trend_synth": lambda spark, folder: undated(StarViews(spark, folder)),
    "panel_heatmap_synth": sales_panel(
        lambda s, scale: panels.synthetic_seasonality(undated(s), scale)
    ),
    "panel_top_stores": sales_panel(panels.top_stores),
    "panel_rev_mix": sales_panel(panels.revenue_mix),
    "panel_rev_mix_top": sales_panel(
        lambda s, scale: panels.revenue_mix_top(panels.revenue_mix(s, scale))
    ),
    "panel_campaign_perf": sales_panel(panels.campaign_scatter),
}
