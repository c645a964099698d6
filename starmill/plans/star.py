"""The retail star as views over the given tables, and its staging as stored tables.

NULL campaigns, orphan campaigns and salespersons, repeated sales ids and shared store names are
part of the star, so that every check has something to find.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.session import fresh_path
from starmill.sources.layers import Layer

DIMENSIONS = [
    "dim_campaigns",
    "dim_customers",
    "dim_dates",
    "dim_products",
    "dim_salespersons",
    "dim_stores",
]
FACT = "fct_sales"
# Views that aggregate or join given tables; the others are narrow scans.
DERIVED_DIMENSIONS = ["dim_campaigns", "dim_dates", "dim_stores"]
DERIVED = [*DERIVED_DIMENSIONS, FACT]

# Known schemas spare a job that reads footers before every query.
GIVEN = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def given_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{folder}/{name}.parquet")


def _day_number(moment: str) -> Column:
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.day(moment)).cast("int")


def _priority_number() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


class StarViews(Mapping[str, DataFrame]):
    """The tables of the star by name, each built when asked for; nothing is read before a job."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._given = cache(lambda name: given_table(spark, folder, name))
        self._views = {
            table: cache(getattr(self, f"_{table}")) for table in [*DIMENSIONS, FACT]
        }

    def __getitem__(self, table: str) -> DataFrame:
        return self._views[table]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._views)

    def __len__(self) -> int:
        return len(self._views)

    def _fct_sales(self) -> DataFrame:
        unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
        return (
            self._given("lineitem")
            .join(self._given("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sales_id"),
                F.col("l_shipdate").alias("sales_date"),
                _day_number("l_shipdate").alias("date_sk"),
                F.col("o_custkey").alias("customer_sk"),
                F.col("l_partkey").alias("product_sk"),
                F.col("l_suppkey").alias("store_sk"),
                (F.col("l_orderkey") % 25).cast("int").alias("salesperson_sk"),
                F.when(~unspecified, _priority_number()).alias("campaign_sk"),
                F.col("l_extendedprice").alias("total_amount"),
            )
        )

    def _dim_campaigns(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        return (
            self._given("orders")
            .where(~priority.isin("4-NOT SPECIFIED", "5-LOW"))
            .select(
                _priority_number().alias("campaign_sk"),
                priority.substr(F.lit(3), F.length(priority)).alias("campaign_name"),
            )
            .distinct()
        )

    def _dim_dates(self) -> DataFrame:
        return (
            self._given("lineitem")
            .select(
                _day_number("l_shipdate").alias("date_sk"),
                F.to_date("l_shipdate").alias("full_date"),
            )
            .distinct()
        )

    def _dim_customers(self) -> DataFrame:
        return self._given("customer").select(
            F.col("c_custkey").alias("customer_sk"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )

    def _dim_products(self) -> DataFrame:
        return self._given("part").select(
            F.col("p_partkey").alias("product_sk"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
        )

    def _dim_stores(self) -> DataFrame:
        return (
            self._given("supplier")
            .join(self._given("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("store_sk"),
                F.col("s_name").alias("store_id"),
                F.col("n_name").alias("store_name"),
                F.col("s_acctbal").alias("balance"),
            )
        )

    def _dim_salespersons(self) -> DataFrame:
        return (
            self._given("nation")
            .where("n_nationkey < 20")
            .select(
                F.col("n_nationkey").alias("salesperson_sk"),
                F.col("n_name").alias("salesperson_name"),
            )
        )


def staged_star(
    spark: SparkSession, folder: str, label: str, tables: Sequence[str] = DERIVED
) -> dict[str, DataFrame]:
    """The star with some of its views written once to the shared folder, the rest as views.

    A suite reads the fact several times. As a stored table each pass is a scan of the columns it
    needs, with row-group statistics; as a view each pass would join the given tables again. It
    also ends the lineage there, so a lost executor costs a few tasks and not the join.
    """
    star = StarViews(spark, folder)
    stored = Layer(spark, fresh_path(spark, label), "mart")
    return {**star, **stored.replace_all({table: star[table] for table in tables})}
