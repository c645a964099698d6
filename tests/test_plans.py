"""The plans that matter at scale: what is scanned, shuffled and broadcast."""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

import pytest

from starmill.operators.first_rows import bounded
from starmill.operators.lookups import LOOKUP_BYTES, is_small, lookup_bytes
from starmill.operators.references import Reference, orphan_counts
from starmill.operators.violations import stored_table_counts
from starmill.plans import declared, marts, sales_panels
from starmill.plans.star import StarViews, staged_star
from starmill.registry import queries
from starmill.sources.exports import export_all_csv
from tests.plans import count, plan_text, scanned_rows

FOLDER = "/root/testdata/sf0.001"
ROW_RULES = [r for r in declared.RETAIL_RULES
             if r.table == declared.SALES and r.family in declared.ROW_RULES]


@pytest.fixture(scope="module")
def star(spark):
    return staged_star(spark, FOLDER, "plan-tests")


def row_counts_of(fact, as_of: datetime):
    kinds = {f.name: f.dataType for f in fact.schema}
    rules = {i: (r.column, declared.violated(r, kinds[r.column], as_of))
             for i, r in enumerate(ROW_RULES)}
    return stored_table_counts(fact, rules, {})


def test_row_rules_share_one_filtered_scan(star) -> None:
    fused, dated = row_counts_of(star["fct_sales"], datetime(2030, 1, 1))
    assert count(fused, "FileScan parquet") == 1 == count(dated, "FileScan parquet")
    assert "IsNull(sales_id)" in plan_text(fused) and "Or(" in plan_text(fused)
    assert len(re.findall(r"ReadSchema: struct<sales_date:timestamp_ntz>", plan_text(dated))) == 1


def test_clean_row_groups_are_not_read(star) -> None:
    fused, _ = row_counts_of(star["fct_sales"], datetime(2030, 1, 1))
    assert sum(scanned_rows(fused)) == 0
    dirty = star["fct_sales"].where("campaign_sk IS NULL")
    assert dirty.count() > 0


def test_small_dimensions_cost_no_shuffle_of_the_fact(star) -> None:
    pointers = {i: Reference(c, star[p.removeprefix("mart.")], c)
                for i, (c, p) in enumerate(declared.PARENTS.items())}
    [probed] = orphan_counts(star["fct_sales"], pointers)
    assert count(probed, "BroadcastHashJoin") >= 5
    assert "SortMergeJoin" not in plan_text(probed)
    fact_scan = "salesperson_sk:int,campaign_sk:int>"
    assert plan_text(probed).count(fact_scan) == 1


def test_large_dimensions_meet_combined_keys(spark, star) -> None:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pointers = {0: Reference("customer_sk", star["dim_customers"], "customer_sk"),
                    1: Reference("product_sk", star["dim_products"], "product_sk")}
        [profiled] = orphan_counts(star["fct_sales"], pointers, broadcast_bytes=0)
        text = plan_text(profiled)
        assert text.count("SortMergeJoin") == 1
        # Keys and parents: the profile is not shuffled again for the join.
        assert text.count("Exchange hashpartitioning") == 2
        assert "partial_count(1)" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_store_mart_shuffles_the_fact_once(star) -> None:
    df = marts.store_daily(star["fct_sales"], star["dim_stores"])
    text = plan_text(df)
    by_day_and_store = [line for line in text.splitlines() if "Exchange hashpartitioning" in line
                        and "_groupingexpression" in line]
    assert len(by_day_and_store) == 1
    assert "SortMergeJoin" not in text
    assert "ReadSchema: struct<sales_date:timestamp_ntz,store_sk:bigint,total_amount:double>" in text


def test_leaderboard_needs_no_full_sort(spark) -> None:
    text = plan_text(sales_panels.top_stores(StarViews(spark, FOLDER)))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_broadcast_joins_first_where_the_dimension_is_small(star) -> None:
    mix = plan_text(sales_panels.revenue_mix(star))
    assert mix.count("Exchange hashpartitioning(category") == 1
    assert "hashpartitioning(product_sk" not in mix
    assert LOOKUP_BYTES <= 64 << 20


def test_only_needed_columns_of_the_given_tables(spark) -> None:
    text = plan_text(declared.evaluate(
        [declared.unique(declared.SALES, "sales_id")],
        declared.qualified(mart={"fct_sales": StarViews(spark, FOLDER)["fct_sales"]}),
    ))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_no_cartesian_product_and_no_python(spark) -> None:
    from starmill.registry.queries import QUERIES

    for name in ("mart_store_daily", "dq_fk", "panel_heatmap_pivot", "panel_campaign_perf"):
        text = plan_text(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
        assert "Python" not in text


def test_one_scan_of_the_given_facts(spark) -> None:
    """Uniqueness of two keys joins the given tables once; floors and bounds read the staged fact."""
    from starmill.registry.queries import QUERIES

    unique = plan_text(QUERIES["dq_unique"](spark, FOLDER))
    assert unique.count("lineitem.parquet") == 1 and unique.count("orders.parquet") == 1
    for name in ("dq_rowcount_floor", "dq_non_negative"):
        text = plan_text(QUERIES[name](spark, FOLDER))
        # The campaigns, if the family reads them, are the only use of the orders left.
        assert "lineitem.parquet" not in text and text.count("orders.parquet") <= 1


def test_synthetic_series_sorts_no_row_that_the_bound_leaves_out(spark, tmp_path) -> None:
    """The scan is filtered below everything that orders, and little is left to order."""
    fact = StarViews(spark, FOLDER)["fct_sales"]
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    kept = bounded(stored, ["sales_date", "sales_id"], 365)
    text = plan_text(kept)
    assert "Filter" in text and "Sort" not in text and "Exchange" not in text
    assert 365 <= kept.count() < 4 * 365 < stored.count()
    series = plan_text(sales_panels.synthetic_trend(stored))
    assert "TakeOrderedAndProject" in series and "Sort [" not in series.split("TakeOrderedAndProject")[-1]
    assert "Window" not in series.split("TakeOrderedAndProject")[-1]


def test_lookups_are_measured_by_their_texts(spark) -> None:
    few = spark.createDataFrame([(1, "n" * 1000), (2, None)], "k bigint, name string")
    assert 1000 < lookup_bytes(few) < 1500
    assert is_small(few, 1500) and not is_small(few, 1000)
    assert lookup_bytes(few.where("false")) == 0


def test_csv_star_joins_the_fact_once_and_is_small(spark, monkeypatch) -> None:
    given = {}

    def kept(tables, folder, **options) -> None:
        given.update(tables)
        export_all_csv(tables, folder, **options)

    monkeypatch.setattr(queries, "export_all_csv", kept)
    # As for tables that Spark takes for large: the stores are measured.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        target, _ = queries.star_csv(spark, FOLDER, "csv-plan")
        assert count(given["fact_sales_denormalized"], "BroadcastHashJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain, wide = given["fact_sales_normalized"], given["fact_sales_denormalized"]
    assert count(plain, "Join") == 0 and "lineitem" not in plan_text(wide)
    for table in ("fact_sales_normalized", "fact_sales_denormalized"):
        stored = sum(f.stat().st_size for f in Path(target.removeprefix("file:"), f"{table}.csv").glob("part-*"))
        text = spark.read.text(f"{target}/{table}.csv").selectExpr("sum(length(value) + 1)").first()[0]
        assert stored < 0.5 * text
