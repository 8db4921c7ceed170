"""The driver's tables, and the retail tables shaped from them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.tables import create_database
from millrace.session import scratch, temporary


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """Database with a name of its own, its tables in the shared scratch folder; released with it."""
    return temporary(spark, "DATABASE", create_database(spark, f"millrace_{uuid.uuid4().hex}", scratch(spark, "database")))


def money(column: str, digits: int = 2) -> Column:
    return F.col(column).cast(f"decimal(18,{digits})")


def products(spark: SparkSession, folder: str) -> DataFrame:
    """ProductID, ProductName (holds a comma), Category, ListPrice."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.concat_ws(", ", "p_name", "p_brand").alias("ProductName"),
        F.col("p_type").alias("Category"),
        money("p_retailprice").alias("ListPrice"),
    )


PRODUCTS_SQL = """
  SELECT p_partkey AS ProductID, p_name || ', ' || p_brand AS ProductName,
         p_type AS Category, CAST(p_retailprice AS DECIMAL(18,2)) AS ListPrice
  FROM part"""


def sales_orders(spark: SparkSession, folder: str) -> DataFrame:
    """OrderID, CustomerName, OrderTotal, OrderType, OrderDate.

    Names have two words, those of pending orders only one.
    """
    orders = table(spark, folder, "orders")
    names = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(names, orders.o_custkey == names.c_custkey).select(
        F.col("o_orderkey").alias("OrderID"),
        F.when(F.col("o_orderstatus") == "P", F.col("c_name"))
        .otherwise(F.concat_ws(" ", "c_mktsegment", "c_name"))
        .alias("CustomerName"),
        F.col("o_totalprice").alias("OrderTotal"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Urgent Order")
        .otherwise("Standard Order")
        .alias("OrderType"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
    )


SALES_ORDERS_SQL = """
  SELECT o_orderkey AS OrderID,
         CASE WHEN o_orderstatus = 'P' THEN c_name ELSE c_mktsegment || ' ' || c_name END AS CustomerName,
         o_totalprice AS OrderTotal,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent Order' ELSE 'Standard Order' END AS OrderType,
         CAST(o_orderdate AS DATE) AS OrderDate
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """CustomerNo, CustomerName, Segment, City, CountryRegion."""
    customer = table(spark, folder, "customer")
    return customer.join(cities(spark, folder), customer.c_nationkey == F.col("CityKey")).select(
        F.col("c_custkey").alias("CustomerNo"),
        F.col("c_name").alias("CustomerName"),
        F.col("c_mktsegment").alias("Segment"),
        "City",
        "CountryRegion",
    )


CUSTOMERS_SQL = """
  SELECT c_custkey AS CustomerNo, c_name AS CustomerName, c_mktsegment AS Segment,
         n_name AS City, r_name AS CountryRegion
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def cities(spark: SparkSession, folder: str) -> DataFrame:
    """CityKey, City, CountryRegion: nations stand for cities."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("CityKey"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("CountryRegion"),
    )


def line_amount() -> Column:
    """Sales amount of an order line, exact in four decimals."""
    discount = F.col("l_discount").cast("decimal(4,2)")
    return (money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - discount)).cast("decimal(18,4)")


# Amounts summed over very many lines are counted in ten-thousandths, as whole
# numbers: computing decimals from doubles line by line costs far more.
UNITS = "0.0001"


def line_units() -> Column:
    """Sales amount of an order line in UNITS, from whole cents and whole percents."""
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.rint(F.col("l_discount") * 100).cast("bigint")
    return (cents * (100 - percent)).cast("decimal(18,0)")


def from_units(total: str) -> Column:
    """Summed units as an amount."""
    return (F.col(total) * F.lit(UNITS).cast("decimal(4,4)")).cast("double")


LINE_AMOUNT_SQL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
)


def order_heads(spark: SparkSession, folder: str) -> DataFrame:
    """OrderNumber, CustomerNo, OrderDate: what the sales fact takes from an order."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("OrderNumber"),
        F.col("o_custkey").alias("CustomerNo"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with business keys and measures, the source of the sales fact."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("OrderNumber"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_suppkey").alias("StoreNo"),
        F.col("l_linenumber").alias("OrderLineItem"),
        F.col("l_quantity").cast("smallint").alias("OrderQuantity"),
        money("l_extendedprice").alias("UnitPrice"),
        money("l_discount").alias("Discount"),
        money("l_tax").alias("Tax"),
        line_amount().alias("SalesAmount"),
    )
