from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmill.plans.discovered import discover, discovered_suite
from starmill.plans.quality_panels import coverage
from tests.star_fixture import small_star

RUN_TS = datetime(2024, 5, 6, 7, 8, 9, 123456)


def rows(checks) -> dict[str, tuple[str, int, int]]:
    return {r.dq_check_name: (r.status, r.failed_rows, r.severity) for r in checks.collect()}


def test_checks_follow_from_names(spark) -> None:
    names = [f"{c.check_type}:{c.table}.{c.column}" for c in discover(small_star(spark))]
    assert "nulls:fct_sales.sales_id" in names
    assert "duplicates:fct_sales.customer_sk" in names
    assert "fk_missing:fct_sales.campaign_sk" in names
    assert not any("sales_date" in n or "total_amount" in n for n in names)


def test_surplus_rows_ignore_null(spark) -> None:
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,), (2,)], "a_sk bigint")
    found = rows(discovered_suite({"dim_a": df}, RUN_TS))
    assert found["mart.dim_a__a_sk__duplicates"] == ("FAIL", 2, 4)
    assert found["mart.dim_a__a_sk__nulls"] == ("FAIL", 2, 3)


def test_table_without_keys_has_no_checks(spark) -> None:
    mart = {
        "dim_a": spark.createDataFrame([(1,)], "a_sk int"),
        "notes": spark.createDataFrame([("x",)], "text string"),
    }
    assert {c.table for c in discover(mart)} == {"dim_a"}


def test_no_tables_or_no_checks_raise(spark) -> None:
    with pytest.raises(ValueError, match="no tables"):
        discover({})
    with pytest.raises(ValueError, match="no checks"):
        discover({"notes": spark.createDataFrame([("x",)], "text string")})


def test_first_dimension_by_name_wins_in_any_case(spark) -> None:
    mart = {
        "dim_b": spark.createDataFrame([(1,), (2,)], "K_SK int"),
        "dim_a": spark.createDataFrame([(1,)], "k_sk int"),
        "fct_x": spark.createDataFrame([(1,), (2,)], "K_sk bigint"),
    }
    found = rows(discovered_suite(mart, RUN_TS))
    assert found["mart.fct_x__K_sk__missing_in_mart.dim_a"] == ("FAIL", 1, 5)


def test_id_column_is_the_key_where_no_surrogate_exists(spark) -> None:
    mart = {"dim_a": spark.createDataFrame([("x",), ("x",)], "a_id string")}
    assert rows(discovered_suite(mart, RUN_TS))["mart.dim_a__a_id__duplicates"] == ("FAIL", 1, 4)


def test_key_override_and_column_limit(spark) -> None:
    star = small_star(spark)
    overridden = discover(star, key_overrides={"fct_sales": "sales_id"}, max_columns=2)
    assert ("duplicates", "sales_id") in {
        (c.check_type, c.column) for c in overridden if c.table == "fct_sales"
    }
    nulls = [c for c in overridden if c.table == "fct_sales" and c.check_type == "nulls"]
    assert len(nulls) == 2


def test_run_time_is_stored_as_given(spark) -> None:
    mart = {"dim_a": spark.createDataFrame([(1,)], "a_sk int")}
    assert {r.run_ts for r in discovered_suite(mart, RUN_TS).collect()} == {RUN_TS}


def test_all_key_columns_are_checked_and_a_limit_is_logged(spark, caplog) -> None:
    wide = spark.range(1).select(*[F.lit(1).alias(f"k{i}_sk") for i in range(30)])
    assert sum(c.check_type == "nulls" for c in discover({"dim_a": wide})) == 30
    with caplog.at_level("WARNING"):
        assert sum(c.check_type == "nulls" for c in discover({"dim_a": wide}, max_columns=29)) == 29
    assert "k29_sk" in caplog.text


def test_empty_tables_count_zero(spark) -> None:
    empty = spark.createDataFrame([], "a_sk bigint")
    checks = discovered_suite({"dim_a": empty, "fct_b": empty}, RUN_TS).collect()
    assert [r.failed_rows for r in checks] == [0] * 5


def test_coverage_has_every_type_that_occurs(spark) -> None:
    checks = spark.createDataFrame(
        [("a", "nulls", "x"), ("a", "bound", "y"), ("b", "odd.type", "z")],
        "table string, check_type string, dq_check_name string",
    )
    matrix = coverage(checks)
    assert matrix.columns == ["table", "nulls", "duplicates", "fk_missing", "bound", "odd.type"]
    assert [tuple(r) for r in matrix.collect()] == [("a", 1, 0, 0, 1, 0), ("b", 0, 0, 0, 0, 1)]
