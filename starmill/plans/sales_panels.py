"""Datasets of the business dashboard: trend, seasonality, leaderboards and mixes.

Facts meet a dimension either broadcast, after a check of its size, or reduced by their key (see
``operators.totals``), so no panel shuffles the rows of the fact and a hot key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starmill.functions import schema_rules as rules
from starmill.functions.calendar import MONTHS, WEEKDAYS, month_name, parse_date_key, weekday_name
from starmill.functions.columns import literal_rows, quoted
from starmill.functions.measures import Measure, measure_of
from starmill.operators.first_rows import first_rows
from starmill.operators.lookups import LOOKUP_BYTES
from starmill.operators.totals import partial_totals, totals_by_attribute
from starmill.sources.scratch import written_once

FACT = "fct_sales"
SYNTHETIC_START = date(2024, 1, 1)
SYNTHETIC_DAYS = 365


def _calendar_date(dates: DataFrame, key: str) -> Column:
    """The date of a row of the date dimension: ``full_date``, else its first date column, else its
    key read as YYYYMMDD."""
    named = rules.preferred(["full_date"], rules.date_columns(dates)) or rules.date_column(dates)
    return F.to_date(quoted(named)) if named else parse_date_key(quoted(key))


def fact_measure(fact: DataFrame, scale: int | None = None) -> Measure:
    return measure_of(fact, rules.measure_column(fact), scale)


def daily_totals(
    mart: Mapping[str, DataFrame], measure: Measure, by_key: DataFrame | None = None
) -> DataFrame | None:
    """(date, total): sales per day, through the date dimension or the fact's own date column.

    None if the fact can be dated neither way. ``by_key`` are totals by date key (``_key``) at hand.
    """
    fact = mart[FACT]
    key = rules.date_key(fact.columns)
    dates = mart.get("dim_dates")
    dates_key = rules.preferred(["date_sk"], dates.columns) if dates is not None else None
    if key and dates_key:
        attributes = {"date": _calendar_date(dates, dates_key)}
        totals = totals_by_attribute(
            fact, key, dates, dates_key, attributes, measure, partial=by_key
        )
        return totals.select("date", "total")
    own = rules.date_column(fact)
    if own and by_key is not None and not key:
        return by_key.where("_key IS NOT NULL").select(F.col("_key").alias("date"), "total")
    if own:
        day = F.to_date(quoted(own)).alias("date")
        dated = fact.where(quoted(own).isNotNull())
        return partial_totals(dated, [day], measure).select("date", "total")
    return None


def sales_trend(
    mart: Mapping[str, DataFrame], scale: int | None = None, daily: DataFrame | None = None
) -> DataFrame:
    """(date, metric) in date order; synthetic dates if the fact has none.

    ``daily`` are the ``daily_totals``, where they are at hand.
    """
    measure = fact_measure(mart[FACT], scale)
    daily = daily_totals(mart, measure) if daily is None else daily
    if daily is None:
        return synthetic_trend(mart[FACT])
    return daily.select("date", measure.value(F.col("total")).alias("metric")).orderBy("date")


def seasonality(
    mart: Mapping[str, DataFrame], scale: int | None = None, daily: DataFrame | None = None
) -> DataFrame:
    """(month, dow, metric) over all years, added up from the daily totals."""
    measure = fact_measure(mart[FACT], scale)
    daily = daily_totals(mart, measure) if daily is None else daily
    if daily is None:
        return synthetic_seasonality(synthetic_trend(mart[FACT]), scale)
    return by_season(daily).agg(measure.value(F.sum("total")).alias("metric"))


def by_season(daily: DataFrame) -> GroupedData:
    day = F.col("date")
    return daily.groupBy(month_name(day).alias("month"), weekday_name(day).alias("dow"))


def seasonality_matrix(heatmap: DataFrame) -> DataFrame:
    """Twelve months by seven weekdays in calendar order, 0 where nothing was sold."""
    calendar = literal_rows(
        heatmap.sparkSession, list(enumerate(MONTHS)), {"rank": "int", "month": "string"}
    )
    # At most 12 rows on either side.
    cells = heatmap.groupBy("month").pivot("dow", WEEKDAYS).agg(F.sum("metric"))
    return (
        calendar.join(F.broadcast(cells), "month", "left")
        .na.fill(0.0, WEEKDAYS)
        .orderBy("rank")
        .select("month", *WEEKDAYS)
    )


def synthetic_trend(
    fact: DataFrame, order_by: Sequence[str] | None = None, days: int = SYNTHETIC_DAYS
) -> DataFrame:
    """(date, metric): the first rows of the fact laid on consecutive days from a fixed start.

    The rows are the first by all columns, or by ``order_by``, so that the series is the same in
    every run. Narrow passes find a bound of them, so the fact itself is not sorted (``operators.first_rows``).
    """
    order_by = order_by or fact.columns
    order = [quoted(c) for c in order_by]
    first = first_rows(fact, order_by, days)
    numbered = first.withColumn("rn", F.row_number().over(W.orderBy(*order)))
    return numbered.select(
        F.date_add(F.lit(SYNTHETIC_START), F.col("rn") - 1).alias("date"),
        quoted(rules.measure_column(fact)).cast("double").alias("metric"),
    )


def synthetic_seasonality(trend: DataFrame, scale: int | None = None) -> DataFrame:
    measure = measure_of(trend, "metric", scale)
    return by_season(trend).agg(measure.value(F.sum(measure.amount)).alias("metric"))


def top_stores(
    mart: Mapping[str, DataFrame], top: int = 15, scale: int | None = None
) -> DataFrame | None:
    """(store, metric): the store names that sold most, best last as a bar chart stacks them.

    None if the fact has no surrogate store key or stores have no names.
    """
    fact, stores = mart[FACT], mart.get("dim_stores")
    key = rules.preferred(rules.STORE_KEYS, fact.columns)
    name = rules.preferred(["store_name"], stores.columns) if stores is not None else None
    if not (key and rules.is_surrogate_key(key) and name):
        return None
    measure = fact_measure(fact, scale)
    totals = totals_by_attribute(
        fact, key, stores, "store_sk", {"store": quoted(name)}, measure, LOOKUP_BYTES
    )
    return (
        totals.select("store", measure.value(F.col("total")).alias("metric"))
        .orderBy(F.desc("metric"), "store")
        .limit(top)
        .orderBy("metric", F.desc("store"))
    )


def revenue_mix(mart: Mapping[str, DataFrame], scale: int | None = None) -> DataFrame | None:
    """(category, metric), largest first; None without a product key or a category."""
    fact, products = mart[FACT], mart.get("dim_products")
    key = rules.preferred(rules.PRODUCT_KEYS, fact.columns)
    category = (
        rules.preferred(rules.CATEGORIES, products.columns) if products is not None else None
    )
    if not (key and rules.is_surrogate_key(key) and category):
        return None
    measure = fact_measure(fact, scale)
    totals = totals_by_attribute(
        fact, key, products, "product_sk", {"category": quoted(category)}, measure,
        LOOKUP_BYTES,
    )
    return totals.select("category", measure.value(F.col("total")).alias("metric")).orderBy(
        F.desc("metric"), "category"
    )


def revenue_mix_top(mix: DataFrame, top: int = 12) -> DataFrame:
    """What the tree map shows of the mix: positive categories, the largest of them."""
    return mix.where("metric > 0").orderBy(F.desc("metric"), "category").limit(top)


def campaign_scatter(
    mart: Mapping[str, DataFrame], top: int = 40, scale: int | None = None
) -> DataFrame | None:
    """(campaign, transactions, avg_order_value, revenue): known campaigns with most revenue."""
    fact, campaigns = mart[FACT], mart.get("dim_campaigns")
    key = rules.preferred(["campaign_sk"], fact.columns)
    if campaigns is None or not key:
        return None
    name = rules.preferred(rules.CAMPAIGN_NAMES, campaigns.columns) or "campaign_sk"
    measure = fact_measure(fact, scale)
    totals = totals_by_attribute(
        fact, key, campaigns, "campaign_sk", {"campaign": quoted(name)}, measure
    )
    return (
        totals.select(
            "campaign",
            F.col("n_rows").cast("double").alias("transactions"),
            measure.mean(F.col("total"), F.col("n_values")).alias("avg_order_value"),
            measure.value(F.col("total")).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "campaign")
        .limit(top)
    )


def sales_panels(
    mart: Mapping[str, DataFrame], scale: int | None = None
) -> dict[str, DataFrame]:
    """Every business panel the tables of a mart allow, by name; none without a fact.

    The fact is reduced once by day, once by product, once by store and once by campaign. What several panels
    show, the totals of days and of categories, is stored in between.
    """
    if FACT not in mart:
        return {}
    daily = daily_totals(mart, fact_measure(mart[FACT], scale))
    mix = revenue_mix(mart, scale)
    if daily is not None:
        daily = written_once(daily, "daily-totals")
        trend, heatmap = sales_trend(mart, scale, daily), seasonality(mart, scale, daily)
    else:
        trend = written_once(synthetic_trend(mart[FACT]), "synthetic-trend")
        heatmap = synthetic_seasonality(trend, scale)
        trend = trend.orderBy("date")
    if mix is not None:
        mix = written_once(mix, "category-totals").orderBy(F.desc("metric"), "category")
    panels = {
        "trend": trend,
        "heatmap": heatmap,
        "heatmap_matrix": seasonality_matrix(heatmap),
        "top_stores": top_stores(mart, scale=scale),
        "rev_mix": mix,
        "rev_mix_top": revenue_mix_top(mix) if mix is not None else None,
        "campaign_perf": campaign_scatter(mart, scale=scale),
    }
    return {name: panel for name, panel in panels.items() if panel is not None}
