from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starmill.functions.calendar import MONTHS, WEEKDAYS
from starmill.operators.totals import partial_totals, totals_by_attribute
from starmill.functions.measures import measure_of
from starmill.plans import marts, sales_panels
from tests.star_fixture import fact_rows, small_star


def test_store_daily_equals_brute_force(spark) -> None:
    """Hot store, NULL and unknown stores, and one store twice in the dimension."""
    star = small_star(spark)
    twice = star["dim_stores"].union(spark.createDataFrame([(2, "S0"), (2, "S9")], "k bigint, n string"))
    names = defaultdict(list)
    for key, name in [(k, f"S{k % 2}") for k in range(5)] + [(2, "S0"), (2, "S9")]:
        names[key].append(name)
    groups = defaultdict(list)
    for row in fact_rows():
        for name in names.get(row[4], [None]):
            groups[(row[1].date(), row[4], name)].append(round(row[7] * 100))
    expected = {k: (len(v), sum(v) / 100, sum(v) / 100 / len(v)) for k, v in groups.items()}
    got = {tuple(r)[:3]: tuple(r)[3:] for r in marts.store_daily(star["fct_sales"], twice, 2).collect()}
    assert got == expected


def test_campaign_mart_keeps_unknown_and_missing(spark) -> None:
    star = small_star(spark)
    rows = marts.campaign_performance(star["fct_sales"], star["dim_campaigns"]).collect()
    keys = {r.campaign_sk for r in rows}
    assert None in keys and {7, 8} <= keys
    assert all((r.campaign_name is None) == (r.campaign_sk is None or r.campaign_sk > 5) for r in rows)
    assert sum(r.transactions for r in rows) == len(fact_rows())
    panel = sales_panels.campaign_scatter(star).collect()
    assert all(r.campaign is not None for r in panel)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_both_ways_to_total_agree_with_rows(spark, broadcast_bytes: int) -> None:
    star = small_star(spark)
    fact, stores = star["fct_sales"], star["dim_stores"]
    stores = stores.union(spark.createDataFrame([(1, "S1"), (None, "S7")], "k bigint, n string"))
    got = totals_by_attribute(
        fact, "store_sk", stores, "store_sk", {"store": F.col("store_name")},
        measure_of(fact, "total_amount", 2), broadcast_bytes,
    ).collect()
    names = [(k, f"S{k % 2}") for k in range(5)] + [(1, "S1")]
    expected = defaultdict(lambda: [0, 0])
    for row in fact_rows():
        for key, name in names:
            if key == row[4]:
                expected[name][0] += 1
                expected[name][1] += round(row[7] * 100)
    assert {r.store: [r.n_rows, r.total] for r in got} == dict(expected)


def test_marts_and_panels_with_a_key_read_as_double(spark) -> None:
    star = small_star(spark)
    same = {**star, "fct_sales": star["fct_sales"].withColumn("campaign_sk", F.col("campaign_sk").cast("double"))}
    for job in (
        lambda m: marts.campaign_performance(m["fct_sales"], m["dim_campaigns"]),
        sales_panels.campaign_scatter,
    ):
        assert {tuple(r) for r in job(same).collect()} == {tuple(r) for r in job(star).collect()}


def test_mean_ignores_null_and_empty_groups_are_null(spark) -> None:
    fact = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "k int, m double")
    measure = measure_of(fact, "m")
    rows = partial_totals(fact, [F.col("k")], measure).select(
        "k", measure.mean(F.col("total"), F.col("n_values")).alias("mean")
    )
    assert {r.k: r.mean for r in rows.collect()} == {1: 2.0, 2: None}


def test_measures_of_other_types(spark) -> None:
    df = spark.sql("SELECT CAST(1.23 AS decimal(9,2)) AS d, 7 AS i, CAST(0.5 AS float) AS f")
    for name, value in (("d", 1.23), ("i", 7.0), ("f", 0.5)):
        measure = measure_of(df, name)
        total = df.agg(F.sum(measure.amount).alias("t"))
        assert total.select(measure.value(F.col("t"))).collect()[0][0] == value


def test_trend_uses_the_date_of_the_dimension(spark) -> None:
    """Running keys, as in the sample calendar, are no dates; the date column is."""
    mart = {
        "dim_dates": spark.createDataFrame(
            [(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "date_sk bigint, full_date date"
        ),
        "fct_sales": spark.createDataFrame([(1, 1.5), (2, 2.0), (2, 0.25), (9, 1.0)],
                                           "date_sk bigint, amount double"),
    }
    rows = [tuple(r) for r in sales_panels.sales_trend(mart).collect()]
    assert rows == [(date(2024, 1, 1), 1.5), (date(2024, 1, 2), 2.25)]


def test_trend_parses_keys_and_raises_on_bad_ones(spark) -> None:
    fact = spark.createDataFrame([(20240229, 1.0)], "order_date_sk bigint, amount double")
    good = {"dim_dates": spark.createDataFrame([(20240229,)], "date_sk bigint"), "fct_sales": fact}
    assert sales_panels.sales_trend(good).collect()[0].date == date(2024, 2, 29)
    bad = {
        "dim_dates": spark.createDataFrame([(60,)], "date_sk bigint"),
        "fct_sales": spark.createDataFrame([(60, 1.0)], "date_sk bigint, amount double"),
    }
    with pytest.raises(Exception, match="not a YYYYMMDD date key: 60"):
        sales_panels.sales_trend(bad).collect()


def test_trend_without_a_date_key(spark) -> None:
    dated = {"fct_sales": spark.createDataFrame(
        [(datetime(2024, 3, 1, 5), 1.0), (datetime(2024, 3, 1, 6), 2.0), (None, 9.0)],
        "sales_date timestamp_ntz, amount double")}
    assert [tuple(r) for r in sales_panels.sales_trend(dated).collect()] == [(date(2024, 3, 1), 3.0)]
    undated = {"fct_sales": spark.createDataFrame([(2, 5.0), (1, 4.0)], "sale_id int, amount double")}
    rows = [tuple(r) for r in sales_panels.sales_trend(undated).collect()]
    assert rows == [(date(2024, 1, 1), 4.0), (date(2024, 1, 2), 5.0)]
    assert [tuple(r) for r in sales_panels.seasonality(undated).orderBy("metric").collect()] == [
        ("Jan", "Mon", 4.0), ("Jan", "Tue", 5.0),
    ]


def test_synthetic_trend_stops_after_a_year(spark) -> None:
    fact = spark.range(1000).selectExpr("id AS sale_id", "CAST(id AS double) AS amount")
    rows = sales_panels.synthetic_trend(fact).orderBy("date").collect()
    assert (len(rows), rows[0].metric, rows[-1].date) == (365, 0.0, date(2024, 12, 30))


def test_matrix_is_dense_and_in_calendar_order(spark) -> None:
    heat = spark.createDataFrame([("Feb", "Sun", 2.0)], "month string, dow string, metric double")
    matrix = sales_panels.seasonality_matrix(heat)
    rows = matrix.collect()
    assert matrix.columns == ["month", *WEEKDAYS]
    assert [r.month for r in rows] == MONTHS
    assert sum(sum(tuple(r)[1:]) for r in rows) == 2.0 == rows[1].Sun


def test_panels_without_their_tables_are_left_out(spark) -> None:
    star = small_star(spark)
    assert sales_panels.sales_panels({}) == {}
    only_fact = sales_panels.sales_panels({"fct_sales": star["fct_sales"]})
    assert set(only_fact) == {"trend", "heatmap", "heatmap_matrix"}
    assert set(sales_panels.sales_panels(star)) == {
        "trend", "heatmap", "heatmap_matrix", "top_stores", "rev_mix", "rev_mix_top",
        "campaign_perf",
    }


def test_no_measure_raises(spark) -> None:
    with pytest.raises(ValueError, match="no numeric measure"):
        sales_panels.sales_trend({"fct_sales": spark.createDataFrame([(1,)], "date_sk int")})


def test_negative_categories_are_shown_only_in_the_full_mix(spark) -> None:
    mart = {
        "dim_products": spark.createDataFrame([(1, "a"), (2, "b")], "product_sk int, category string"),
        "fct_sales": spark.createDataFrame([(1, 3.0), (2, -1.0)], "product_sk int, amount double"),
    }
    mix = sales_panels.revenue_mix(mart)
    assert [r.category for r in mix.collect()] == ["a", "b"]
    assert [r.category for r in sales_panels.revenue_mix_top(mix).collect()] == ["a"]


def total_of(df, name: str, scale: int | None = None) -> float:
    measure = measure_of(df, name, scale)
    return df.agg(measure.value(F.sum(measure.amount)).alias("t")).collect()[0].t


def test_sums_keep_what_is_finer_than_a_cent(spark) -> None:
    df = spark.range(1000).select(F.lit(0.004).alias("M"))
    assert total_of(df, "m") == pytest.approx(4.0)
    assert total_of(df, "m", 3) == 4.0
    with pytest.raises(Exception, match="not a number of 2 decimal places in M: 0.004"):
        total_of(df, "m", 2)


def test_no_number_and_null_in_sums(spark) -> None:
    df = spark.sql("SELECT CAST(v AS double) AS m FROM VALUES ('1.5'), ('NaN'), (NULL) AS t(v)")
    assert str(total_of(df, "m")) == "nan"
    assert total_of(df.where("m < 9 OR m IS NULL"), "m", 2) == 1.5
    with pytest.raises(Exception, match="(?i)cast|decimal places"):
        total_of(df, "m", 2)


def test_cents_of_any_size_fit_their_scale(spark) -> None:
    cents = [0, 1, -1, 115, 100_000_001, 999_999_999_999_99, -123_456_789_012_34]
    df = spark.createDataFrame([(c / 100,) for c in cents], "m double")
    measure = measure_of(df, "m", 2)
    assert [r.a for r in df.select(measure.amount.alias("a")).collect()] == cents


def test_calendar_prefers_its_full_date(spark) -> None:
    mart = {
        "dim_dates": spark.createDataFrame(
            [(1, date(2000, 1, 1), date(2024, 5, 6))],
            "date_sk bigint, loaded_on date, Full_Date date",
        ),
        "fct_sales": spark.createDataFrame([(1, 1.5)], "date_sk bigint, amount double"),
    }
    assert [r.date for r in sales_panels.sales_trend(mart).collect()] == [date(2024, 5, 6)]


def test_synthetic_trend_over_many_tasks_is_the_first_rows(spark) -> None:
    fact = spark.range(0, 5000, 1, 40).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.col("id").cast("double").alias("amount")
    )
    rows = sales_panels.synthetic_trend(fact, days=30).orderBy("date").collect()
    first = sorted((i * 7919 % 5000, float(i)) for i in range(5000))[:30]
    assert [r.metric for r in rows] == [amount for _, amount in first]
