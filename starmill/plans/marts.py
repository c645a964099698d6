"""The two summary marts of the analytics layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.measures import Measure, measure_of
from starmill.operators.lookups import LOOKUP_BYTES
from starmill.operators.totals import named_totals, partial_totals


def amount_of(fact: DataFrame, scale: int | None = None) -> Measure:
    return measure_of(fact, "total_amount", scale)


def store_days(fact: DataFrame, scale: int | None = None, *more: Column) -> DataFrame:
    """Partial totals by sales day and store, and by ``more``."""
    day = F.to_date("sales_date").alias("sales_day")
    return partial_totals(fact, [*more, day, F.col("store_sk")], amount_of(fact, scale))


def named_store_days(by_day: DataFrame, stores: DataFrame, amount: Measure) -> DataFrame:
    """The daily mart from its partial totals; stores that are not known have a NULL name."""
    named = named_totals(by_day, "store_sk", stores, ["store_name"], LOOKUP_BYTES)
    return named.select(
        "sales_day",
        "store_sk",
        "store_name",
        F.col("n_rows").alias("transactions"),
        amount.value(F.col("total")).alias("revenue"),
        amount.mean(F.col("total"), F.col("n_values")).alias("avg_order_value"),
    )


def store_daily(fact: DataFrame, stores: DataFrame, scale: int | None = None) -> DataFrame:
    """One row per sales day and store: transactions, revenue and average order value.

    Sales without a known store are kept, with a NULL name. The one shuffle of the fact is by day
    and store after a map-side combine; the name joins the daily rows.
    """
    return named_store_days(store_days(fact, scale), stores, amount_of(fact, scale))


def campaign_totals(fact: DataFrame, scale: int | None = None, *more: Column) -> DataFrame:
    """Partial totals by campaign, and by ``more``, with the first and last day."""
    day = F.to_date("sales_date")
    return partial_totals(
        fact,
        [*more, F.col("campaign_sk")],
        amount_of(fact, scale),
        F.min(day).alias("first_sale_day"),
        F.max(day).alias("last_sale_day"),
    )


def merged_campaigns(partial: DataFrame) -> DataFrame:
    """Totals by campaign of several periods, added up."""
    return partial.groupBy("campaign_sk").agg(
        *[F.sum(name).alias(name) for name in ("n_rows", "n_values", "total")],
        F.min("first_sale_day").alias("first_sale_day"),
        F.max("last_sale_day").alias("last_sale_day"),
    )


def named_campaigns(by_campaign: DataFrame, campaigns: DataFrame, amount: Measure) -> DataFrame:
    """The campaign mart from its partial totals."""
    return named_totals(by_campaign, "campaign_sk", campaigns, ["campaign_name"]).select(
        "campaign_sk",
        "campaign_name",
        F.col("n_rows").alias("transactions"),
        amount.value(F.col("total")).alias("revenue"),
        amount.mean(F.col("total"), F.col("n_values")).alias("avg_order_value"),
        "first_sale_day",
        "last_sale_day",
    )


def campaign_performance(
    fact: DataFrame, campaigns: DataFrame, scale: int | None = None
) -> DataFrame:
    """One row per campaign, unknown and missing campaigns included, with its first and last day."""
    return named_campaigns(campaign_totals(fact, scale), campaigns, amount_of(fact, scale))
