"""A small star with NULLs, orphans, repeats and a hot key, and brute-force answers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

FACT_SCHEMA = (
    "sales_id bigint, sales_date timestamp_ntz, customer_sk bigint, product_sk bigint, "
    "store_sk bigint, salesperson_sk int, campaign_sk int, total_amount double"
)


def fact_rows(n: int = 600) -> list[tuple]:
    """Every third row belongs to store 1 and campaign 1; some keys are NULL or unknown."""
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(
            (
                i if i % 50 else 7,
                datetime(2024, 1, 1) + timedelta(days=i % 40, hours=i % 24),
                None if i % 97 == 0 else i % 11,
                i % 13,
                1 if hot else (None if i % 89 == 0 else i % 7),
                i % 5,
                1 if hot else (None if i % 4 == 0 else i % 9),
                round((i * 37 % 1000) / 7, 2) if i % 61 else -1.5,
            )
        )
    return rows


def small_star(spark: SparkSession, rows: list[tuple] | None = None) -> dict[str, DataFrame]:
    frame = spark.createDataFrame
    return {
        "dim_campaigns": frame(
            [(k, f"C{k}") for k in range(6)], "campaign_sk int, campaign_name string"
        ),
        "dim_customers": frame([(k, f"N{k}") for k in range(11)], "customer_sk bigint, name string"),
        "dim_products": frame(
            [(k, f"T{k % 3}") for k in range(12)], "product_sk bigint, category string"
        ),
        "dim_salespersons": frame([(k,) for k in range(5)], "salesperson_sk int"),
        "dim_stores": frame(
            [(k, f"S{k % 2}") for k in range(5)], "store_sk bigint, store_name string"
        ),
        "fct_sales": frame(fact_rows() if rows is None else rows, FACT_SCHEMA),
    }
