"""Known counts of the star at sf0.01."""

from __future__ import annotations

import pytest

from starmill.plans.star import StarViews
from starmill.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def failed(spark, name: str, key: str = "check_name") -> dict[str, int]:
    return {r[key]: r.failed_rows for r in QUERIES[name](spark, FOLDER).collect()}


def test_star_sizes(spark) -> None:
    sizes = {t: df.count() for t, df in StarViews(spark, FOLDER).items()}
    assert sizes == {
        "fct_sales": 60000, "dim_customers": 1500, "dim_products": 2000, "dim_stores": 100,
        "dim_salespersons": 20, "dim_campaigns": 3, "dim_dates": 2499,
    }


def test_declared_failures(spark) -> None:
    checks = failed(spark, "dq_suite_declared")
    assert len(checks) == 21
    assert {k: v for k, v in checks.items() if v} == {
        "mart.fct_sales__sales_id__unique": 11785,
        "mart.fct_sales__salesperson_sk_fk__references_dim_salespersons.salesperson_sk": 11880,
        "mart.fct_sales__campaign_sk_fk__references_dim_campaigns.campaign_sk": 12017,
        "mart.fct_sales__sales_date__not_future": 3651,
        "analytics.mart_campaign_perf__campaign_name__not_null": 2,
    }


def test_discovered_failures(spark) -> None:
    checks = failed(spark, "dq_suite_auto", "dq_check_name")
    assert len(checks) == 27
    assert {k: v for k, v in checks.items() if v} == {
        "mart.fct_sales__campaign_sk__nulls": 12056,
        "mart.fct_sales__date_sk__duplicates": 57501,
        "mart.fct_sales__salesperson_sk__missing_in_mart.dim_salespersons": 11880,
        "mart.fct_sales__campaign_sk__missing_in_mart.dim_campaigns": 12017,
    }


def test_rule_families(spark) -> None:
    assert failed(spark, "dq_unique")["mart.fct_sales__campaign_sk__unique"] == 5
    assert failed(spark, "dq_not_null")["mart.fct_sales__campaign_sk__not_null"] == 12056
    assert failed(spark, "dq_non_negative")["mart.dim_customers__balance__non_negative"] == 122
    assert failed(spark, "dq_not_absurd")["mart.fct_sales__total_amount__not_absurd_100000"] == 2824


def test_leaderboard(spark) -> None:
    rows = QUERIES["panel_top_stores"](spark, FOLDER).collect()
    assert (rows[-1].store, rows[-1].metric) == ("NATION_9", 317804621.11)
    assert (rows[0].store, rows[0].metric) == ("NATION_4", 97169427.16)


def test_history(spark) -> None:
    rows = QUERIES["dq_history_last_k"](spark, FOLDER).collect()
    assert [(r.run_ts.year, r.total_failed_rows) for r in rows] == [
        (1998, 1780 + 1748 + 377), (1999, 1774 + 1741 + 390), (2000, 1700 + 1770 + 407),
        (2001, 1765 + 1841 + 414), (2002, 1458 + 1378 + 354),
    ]


@pytest.mark.parametrize(
    ("name", "rows"),
    [("mart_store_daily", 53307), ("mart_campaign_perf", 5), ("panel_trend", 2499),
     ("panel_heatmap", 84), ("panel_rev_mix", 6), ("panel_campaign_perf", 3),
     ("panel_trend_synth", 365), ("sample_fact_exact", 2000)],
)
def test_sizes(spark, name: str, rows: int) -> None:
    assert QUERIES[name](spark, FOLDER).count() == rows
