"""Monthly totals after files came, changed and went, against totals of the whole fact."""

from __future__ import annotations

import json
import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starmill.plans import incremental, marts
from starmill.plans.incremental import MonthlyTotals, retail_builds
from starmill.plans.pipeline import Warehouse, append_sales, refresh_marts
from starmill.plans.sales_panels import sales_trend
from starmill.plans.star import FACT
from starmill.sources.exports import export_csv
from tests.star_fixture import FACT_SCHEMA, small_star


def rows_of(df) -> Counter:
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def sales(spark, first: datetime, days: int, n: int, store: int = 1):
    rows = [
        (i, first + timedelta(days=i % days, hours=1), 1, 2, store + i % 3, 1, i % 4 or None, round(i * 1.37, 2))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FACT_SCHEMA)


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path))
    star = small_star(spark)
    dates = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS full_date")
    made.mart.replace_all({**{t: df for t, df in star.items() if t != FACT}, "dim_dates": dates, FACT: star[FACT]})
    return made


def same_as_whole(warehouse: Warehouse, found: dict) -> None:
    fact = warehouse.mart.read(FACT)
    whole = {
        "mart_store_daily": marts.store_daily(fact, warehouse.mart.read("dim_stores"), 2),
        "mart_campaign_perf": marts.campaign_performance(fact, warehouse.mart.read("dim_campaigns"), 2),
        "daily_totals": sales_trend(warehouse.mart.tables(), 2),
    }
    assert set(found) == set(whole)
    for name, df in whole.items():
        assert rows_of(found[name]) == rows_of(df), name


def months_of(warehouse: Warehouse) -> dict[str, str]:
    folder = f"{warehouse.root}/monthly/scale-2/commits"
    with open(f"{folder}/{max(n for n in os.listdir(folder) if n.isdigit())}") as commit:
        return json.load(commit)["months"]


def test_one_new_file_rewrites_its_month_only(spark, warehouse, tmp_path) -> None:
    months, found = refresh_marts(warehouse, 2)
    assert months == ["2024-01", "2024-02"]
    same_as_whole(warehouse, found)
    before = months_of(warehouse)
    export_csv(sales(spark, datetime(2024, 3, 5), 3, 30), str(tmp_path / "new.csv"))
    append_sales(warehouse, str(tmp_path / "new.csv"))
    months, found = refresh_marts(warehouse, 2)
    after = months_of(warehouse)
    assert months == ["2024-03"] == sorted(set(after) - set(before))
    assert {m: after[m] for m in before} == before
    same_as_whole(warehouse, found)
    warehouse.mart.append(FACT, sales(spark, datetime(2024, 2, 1), 2, 9))
    assert refresh_marts(warehouse, 2)[0] == ["2024-02"]
    same_as_whole(warehouse, refresh_marts(warehouse, 2)[1])


def test_nothing_new_reads_and_writes_nothing(spark, warehouse) -> None:
    refresh_marts(warehouse, 2)
    folder = f"{warehouse.root}/monthly/scale-2"
    held = sorted(os.listdir(folder)), sorted(os.listdir(f"{folder}/commits"))
    assert refresh_marts(warehouse, 2)[0] == []
    assert held == (sorted(os.listdir(folder)), sorted(os.listdir(f"{folder}/commits")))


def test_only_files_of_affected_months_are_read(spark, warehouse, monkeypatch) -> None:
    for month in (4, 5, 6):
        warehouse.mart.append(FACT, sales(spark, datetime(2024, month, 1), 5, 20).coalesce(1))
    refresh_marts(warehouse, 2)
    warehouse.mart.append(FACT, sales(spark, datetime(2024, 5, 9), 2, 7).coalesce(1))
    read = []
    rows = MonthlyTotals._rows

    def watched(self, manifest, months, paths):
        found = rows(self, manifest, months, paths)
        read.append(set(found.inputFiles()))
        return found

    monkeypatch.setattr(MonthlyTotals, "_rows", watched)
    assert refresh_marts(warehouse, 2)[0] == ["2024-05"]
    assert len(read[0]) == 2 < len(warehouse.mart.read(FACT).inputFiles())
    same_as_whole(warehouse, refresh_marts(warehouse, 2)[1])


def test_replaced_and_emptied_fact(spark, warehouse) -> None:
    refresh_marts(warehouse, 2)
    warehouse.mart.replace(FACT, sales(spark, datetime(2024, 2, 10), 4, 40, store=3))
    months, found = refresh_marts(warehouse, 2)
    assert months == ["2024-01", "2024-02"] and set(months_of(warehouse)) == {"2024-02"}
    same_as_whole(warehouse, found)
    warehouse.mart.replace(FACT, warehouse.mart.read(FACT).where("false"))
    assert refresh_marts(warehouse, 2) == (["2024-02"], {})
    warehouse.mart.replace(FACT, sales(spark, datetime(2024, 7, 1), 1, 5))
    months, found = refresh_marts(warehouse, 2)
    assert months == ["2024-07"]
    same_as_whole(warehouse, found)


def test_sales_without_a_date_have_a_month_of_their_own(spark, warehouse) -> None:
    refresh_marts(warehouse, 2)
    undated = sales(spark, datetime(2024, 2, 1), 1, 6).withColumn("sales_date", F.lit(None).cast("timestamp_ntz"))
    warehouse.mart.append(FACT, undated)
    months, found = refresh_marts(warehouse, 2)
    assert months == ["none"]
    whole = marts.store_daily(warehouse.mart.read(FACT), warehouse.mart.read("dim_stores"), 2)
    assert rows_of(found["mart_store_daily"]) == rows_of(whole)


def test_names_in_paths(spark, tmp_path) -> None:
    """Blanks, plus and percent signs in a folder's name, as file listing and metadata write them differently."""
    folder = f"{tmp_path}/a b+c%20d=e"
    sales(spark, datetime(2024, 2, 1), 3, 9).coalesce(1).write.parquet(folder)
    stored = MonthlyTotals(spark, f"{tmp_path}/totals", "sales_date", retail_builds(2))
    assert stored.refresh([folder]) == ["2024-02"] and stored.refresh([folder]) == []
    sales(spark, datetime(2024, 3, 1), 3, 9).coalesce(1).write.mode("append").parquet(folder)
    assert stored.refresh([folder]) == ["2024-03"]


def test_refresh_that_another_forestalls_starts_again(spark, warehouse, monkeypatch) -> None:
    commit, nested = incremental.CommitLog.commit_after, []

    def late(self, number: int, text: str) -> bool:
        if not nested and "monthly" in self.folder:
            nested.append(number)
            refresh_marts(warehouse, 2)
        return commit(self, number, text)

    monkeypatch.setattr(incremental.CommitLog, "commit_after", late)
    months, found = refresh_marts(warehouse, 2)
    assert months == [] and set(months_of(warehouse)) == {"2024-01", "2024-02"}
    same_as_whole(warehouse, found)


def test_totals_that_nobody_names_go(spark, warehouse) -> None:
    refresh_marts(warehouse, 2)
    folder = f"{warehouse.root}/monthly/scale-2"
    warehouse.mart.replace(FACT, sales(spark, datetime(2024, 2, 10), 4, 40))
    stored = MonthlyTotals(spark, folder, "sales_date", retail_builds(2), retained=-1)
    stored.refresh(warehouse.mart.paths(FACT))
    named = {name for name in os.listdir(folder) if name.startswith("data-")}
    assert named == set(months_of(warehouse).values())
