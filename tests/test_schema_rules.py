from __future__ import annotations

from starmill.functions import schema_rules as rules


def test_date_key_preference() -> None:
    assert rules.date_key(["x_date_sk", "ORDER_DATE_SK", "date_sk"]) == "date_sk"
    assert rules.date_key(["ship_date_sk", "Sale_Date_SK"]) == "Sale_Date_SK"
    assert rules.date_key(["a", "ship_date_sk"]) == "ship_date_sk"
    assert rules.date_key(["dates_sk", "store_sk"]) == "dates_sk"
    assert rules.date_key(["sales_date", "store_sk"]) is None


def test_measure_choice(spark) -> None:
    pick = lambda ddl: rules.measure_column(spark.createDataFrame([], ddl))
    assert pick("qty int, Amount double, revenue double") == "revenue"
    assert pick("qty int, AMOUNT double") == "AMOUNT"
    assert pick("store_sk int, order_id int, note string, qty int") == "qty"


def test_interval_is_no_measure(spark) -> None:
    df = spark.sql("SELECT INTERVAL 1 DAY AS wait, 2 AS qty")
    assert rules.measure_column(df) == "qty"


def test_key_names_ignore_case() -> None:
    assert rules.is_key("STORE_SK") and rules.is_key("Order_Id") and not rules.is_key("skid")
    assert rules.preferred(["b", "A"], ["a", "B"]) == "B"
