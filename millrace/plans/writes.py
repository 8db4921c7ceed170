"""Queries: file sinks, table sinks, loads and table placement. Each reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.tables import create_table
from millrace.functions.text import split_name
from millrace.operators.layout import replicated, round_robin, save_hashed
from millrace.plans.inputs import (
    CUSTOMERS_SQL,
    PRODUCTS_SQL,
    SALES_ORDERS_SQL,
    cities,
    customers,
    new_database,
    products,
    sales_orders,
    table,
)
from millrace.plans.scans import write_csv
from millrace.session import scratch
from millrace.sinks import folders, tables
from millrace.sources.lake import Lake, delimited_format, parquet_format


def _bigint(df, *columns):
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _dated(spark, folder):
    return sales_orders(spark, folder).withColumn("Year", F.year("OrderDate"))


def sink_parquet_overwrite(spark, folder):
    """Written, then replaced by a frame computed from the same folder."""
    path = f"{scratch(spark, 'transformed')}/orders.parquet"
    folders.replace_folder(sales_orders(spark, folder), path)
    folders.replace_folder(split_name(spark.read.parquet(path), "CustomerName"), path)
    return spark.read.parquet(path)


def sink_partition_year(spark, folder):
    """Partitioned by year; one year is then written anew, the others stay."""
    path = scratch(spark, "by-year")
    folders.replace_folder(_dated(spark, folder), path, ["Year"])
    corrected = spark.read.parquet(path).where("Year = 1999").withColumn("OrderTotal", F.lit(0.0))
    again = scratch(spark, "corrected")
    corrected.write.parquet(again)
    folders.replace_partitions(spark.read.parquet(again), path, ["Year"])
    return _bigint(spark.read.parquet(path), "Year")


def sink_external_table(spark, folder):
    name = f"{new_database(spark)}.sales_orders"
    tables.save_external(sales_orders(spark, folder), name, scratch(spark, "external"))
    return spark.table(name)


def _year_month_table(spark, folder):
    database = new_database(spark)
    tables.save_external(sales_orders(spark, folder), f"{database}.sales_orders", scratch(spark, "external"))
    derived = spark.table(f"{database}.sales_orders").withColumns(
        {"Year": F.year("OrderDate"), "Month": F.month("OrderDate")}
    )
    name = f"{database}.orders_by_month"
    tables.save_external(derived, name, scratch(spark, "transformed"), ["Year", "Month"])
    return name


def sink_partition_year_month(spark, folder):
    return _bigint(spark.table(_year_month_table(spark, folder)), "Year", "Month")


def filter_partition_pruned(spark, folder):
    name = _year_month_table(spark, folder)
    return _bigint(spark.sql(f"SELECT * FROM {name} WHERE Year = 2000 AND Month = 1"), "Year", "Month")


def sink_managed_table(spark, folder):
    return tables.save_managed(customers(spark, folder), f"{new_database(spark)}.customers")


def ctas(spark, folder):
    name = f"{new_database(spark)}.DimProduct"
    products(spark, folder).createOrReplaceTempView("ctas_products")
    spark.sql(
        f"""CREATE TABLE {name} USING parquet AS
            SELECT ProductID AS StockCode, ProductName, Category, CAST(ListPrice AS DOUBLE) AS ListPrice
            FROM ctas_products"""
    )
    spark.catalog.dropTempView("ctas_products")
    return spark.table(name)


def _order_lake(spark, folder):
    lake = Lake(spark)
    lake.create_source("files", scratch(spark, "lake"))
    lake.create_format("CsvFormat", delimited_format())
    lake.create_format("ParquetFormat", parquet_format())
    lake.write(sales_orders(spark, folder), "sales_orders", "files", "CsvFormat", header="true")
    return lake


def cetas_special_orders(spark, folder):
    """Once from a source-relative path, once from a full path."""
    lake = _order_lake(spark, folder)
    database = new_database(spark)
    source = {"relative": ("sales_orders/*.csv", "files"), "full": (lake.path("sales_orders/*.csv", "files"), None)}
    results = []
    for kind, (location, name) in source.items():
        read = lake.read(location, name, "CsvFormat", header="true", inferSchema="true")
        special = read.where("OrderType = 'Urgent Order'").select(
            F.col("OrderID").cast("bigint").alias("OrderID"), "CustomerName", "OrderTotal"
        )
        stored = lake.table_as_select(
            special, f"{database}.UrgentSales_{kind}", f"urgent_{kind}", "files", "ParquetFormat"
        )
        results.append(stored.withColumn("source_path", F.lit(kind)))
    return results[0].unionByName(results[1])


def rebuild_special_orders_by_year(spark, folder):
    """The table is built for one year and rebuilt for another."""
    lake = _order_lake(spark, folder)
    database = new_database(spark)
    schema = "OrderID BIGINT, CustomerName STRING, OrderTotal DOUBLE, OrderType STRING, OrderDate DATE"
    lake.external_table(f"{database}.sales_orders", schema, "sales_orders/*.csv", "files", "CsvFormat", header="true")
    query = f"""SELECT OrderID, CustomerName, OrderTotal FROM {database}.sales_orders
                WHERE OrderType = 'Urgent Order' AND YEAR(OrderDate) = :order_year"""
    name, path = f"{database}.UrgentSales", lake.path("urgent", "files")
    for year in (1997, 1998):
        result = tables.rebuild_external(spark, name, path, query, order_year=year)
    return result


def insert_select(spark, folder):
    name = f"{new_database(spark)}.DimCustomer"
    create_table(spark, name, "CustAltKey BIGINT, CustomerName STRING, City STRING")
    customers(spark, folder).createOrReplaceTempView("insert_customers")
    spark.sql(f"INSERT INTO {name} SELECT CustomerNo, CustomerName, City FROM insert_customers")
    spark.catalog.dropTempView("insert_customers")
    return spark.table(name)


def insert_values(spark, folder):
    name = f"{new_database(spark)}.Customer"
    people = split_name(
        customers(spark, folder).select(F.col("CustomerNo").alias("CustomerID"), F.concat_ws(" ", "Segment", "CustomerName").alias("Name")),
        "Name",
    )
    tables.save_managed(people, name)
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'Mill', 'Race')")
    return spark.table(name)


_STAGE = (
    "StockKey BIGINT, ProductID BIGINT, ProductName STRING, Category STRING, ListPrice DECIMAL(18,2), Withdrawn BOOLEAN"
)


def copy_into_staging(spark, folder):
    """Two Parquet loads by column list; keys are made, the files' own key is refused."""
    name = f"{new_database(spark)}.Arrivals"
    create_table(spark, name, _STAGE)
    incoming = products(spark, folder).withColumn("StockKey", -F.col("ProductID"))
    columns = ["StockKey", "ProductID", "ProductName", "Category", "ListPrice"]
    for part in ("Category IN ('PROMO', 'SMALL', 'LARGE')", "Category NOT IN ('PROMO', 'SMALL', 'LARGE')"):
        path = scratch(spark, "staged")
        incoming.where(part).write.parquet(f"{path}/products1.parquet")
        tables.copy_into(
            spark, name, columns, f"{path}/products*.parquet", identity=("StockKey", ["ProductID"])
        )
    return spark.table(name).withColumn("ListPrice", F.col("ListPrice").cast("double"))


def copy_into_maxerrors(spark, folder):
    """Rows of one brand have text where the id belongs; they are within the allowance."""
    name = f"{new_database(spark)}.Arrivals"
    create_table(spark, name, "ProductID BIGINT, ProductName STRING, Size INT")
    parts = table(spark, folder, "part")
    broken = F.when(F.col("p_brand") == "Brand#7", F.concat(F.lit("id-"), "p_partkey")).otherwise(
        F.col("p_partkey").cast("string")
    )
    path = write_csv(parts.select(broken.alias("ProductID"), "p_name", "p_size"), header=False)
    allowed = parts.where("p_brand = 'Brand#7'").count()
    tables.copy_into(spark, name, ["ProductID", "ProductName", "Size"], path, "CSV", max_errors=allowed)
    return spark.table(name)


def copy_into_constraints(spark, folder):
    """Rows without a category or with a long name break the table's rules; loaded and left out are all rows."""
    name = f"{new_database(spark)}.Arrivals"
    create_table(spark, name, "ProductID BIGINT, ProductName STRING, Category STRING")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.nullif("p_type", F.lit("PROMO")).alias("Category"),
    )
    path = write_csv(parts, header=False)
    allowed = parts.where("Category IS NULL OR char_length(ProductName) > 9").count()
    left_out = tables.copy_into(
        spark, name, parts.columns, path, "CSV", max_errors=allowed,
        not_null=["Category"], max_lengths={"ProductName": 9},
    )
    loaded = spark.table(name).withColumn("loaded", F.lit(True))
    return loaded.unionByName(left_out.select(*parts.columns, F.lit(False).alias("loaded")))


def copy_into_rejects(spark, folder):
    """The rows a load leaves out, with all the rules each one breaks."""
    name = f"{new_database(spark)}.Arrivals"
    create_table(spark, name, "PartNo BIGINT, PartName STRING, Kind STRING")
    parts = table(spark, folder, "part").select(
        F.when(F.col("p_brand") == "Brand#7", F.concat(F.lit("no-"), "p_partkey")).otherwise(F.col("p_partkey").cast("string")).alias("PartNo"),
        F.col("p_name").alias("PartName"),
        F.nullif("p_type", F.lit("PROMO")).alias("Kind"),
    )
    path = write_csv(parts, header=False)
    left_out = tables.copy_into(
        spark, name, parts.columns, path, "CSV", max_errors=parts.count(), not_null=["Kind"], max_lengths={"PartName": 9}
    )
    return left_out.select("PartName", "Kind", F.array_join(tables.REASONS, "; ").alias("Reasons"))


def rename_swap(spark, folder):
    """The current table is archived, the rebuilt one takes its name."""
    database = new_database(spark)
    current = customers(spark, folder).select("CustomerNo", "City")
    tables.save_managed(current, f"{database}.DimCustomer")
    tables.save_managed(current.withColumn("City", F.lower("City")), f"{database}.DimCustomerUpsert")
    tables.swap(spark, f"{database}.DimCustomer", f"{database}.DimCustomerUpsert", f"{database}.DimCustomerArchive")
    old = spark.table(f"{database}.DimCustomerArchive").select("CustomerNo", F.col("City").alias("OldCity"))
    return spark.table(f"{database}.DimCustomer").join(old, "CustomerNo")


# ---- placement --------------------------------------------------------------

def layout_hash(spark, folder):
    """Lines and orders distributed alike on the order number, joined without a shuffle."""
    database = new_database(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("OrderNumber"), "l_quantity")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("OrderNumber"), "o_orderstatus")
    save_hashed(lines, f"{database}.FactSales", "OrderNumber", buckets, scratch(spark, "hashed"))
    save_hashed(orders, f"{database}.Orders", "OrderNumber", buckets, scratch(spark, "hashed"))
    joined = spark.table(f"{database}.FactSales").join(spark.table(f"{database}.Orders").hint("merge"), "OrderNumber")
    return joined.groupBy("o_orderstatus").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


def layout_round_robin(spark, folder):
    """Evenly spread staging rows: partition sizes differ by a few rows only."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    path = scratch(spark, "staged")
    round_robin(lines).withColumn("slice", F.spark_partition_id()).write.parquet(path)
    slices = spark.read.parquet(path).groupBy("slice").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    )
    even = F.max("n") - F.min("n") <= F.greatest(F.lit(8), F.sum("n") / 1000)
    return slices.agg(F.sum("n").alias("row_count"), F.sum("q").alias("quantity"), even.alias("even"))


def layout_replicate_join(spark, folder):
    """A small dimension copied to every task, after a check of its size."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice")
    who = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    spent = orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    per_nation = spent.join(replicated(who), F.col("o_custkey") == F.col("c_custkey"))
    named = per_nation.join(replicated(cities(spark, folder)), F.col("c_nationkey") == F.col("CityKey"))
    return named.groupBy("City").agg(F.sum("total").cast("double").alias("total"))


_SPECIAL = f"""SELECT OrderID, CustomerName, OrderTotal FROM ({SALES_ORDERS_SQL})
               WHERE OrderType = 'Urgent Order'"""
_YEAR_MONTH = f"""SELECT *, CAST(year(OrderDate) AS BIGINT) AS Year, CAST(month(OrderDate) AS BIGINT) AS Month
                  FROM ({SALES_ORDERS_SQL})"""

QUERIES = {
    "sink_parquet_overwrite": (
        sink_parquet_overwrite,
        f"""SELECT OrderID, OrderTotal, OrderType, OrderDate, split_part(CustomerName, ' ', 1) AS FirstName,
                   nullif(split_part(CustomerName, ' ', 2), '') AS LastName FROM ({SALES_ORDERS_SQL})""",
    ),
    "sink_partition_year": (
        sink_partition_year,
        f"""SELECT OrderID, CustomerName, OrderType, OrderDate, CAST(year(OrderDate) AS BIGINT) AS Year,
                   CASE WHEN year(OrderDate) = 1999 THEN 0.0 ELSE OrderTotal END AS OrderTotal
            FROM ({SALES_ORDERS_SQL})""",
    ),
    "sink_external_table": (sink_external_table, SALES_ORDERS_SQL),
    "sink_partition_year_month": (sink_partition_year_month, _YEAR_MONTH),
    "filter_partition_pruned": (
        filter_partition_pruned,
        f"SELECT * FROM ({_YEAR_MONTH}) WHERE Year = 2000 AND Month = 1",
    ),
    "sink_managed_table": (sink_managed_table, CUSTOMERS_SQL),
    "ctas": (
        ctas,
        f"""SELECT ProductID AS StockCode, ProductName, Category, CAST(ListPrice AS DOUBLE) AS ListPrice
            FROM ({PRODUCTS_SQL})""",
    ),
    "cetas_special_orders": (
        cetas_special_orders,
        f"SELECT s.*, source_path FROM ({_SPECIAL}) s CROSS JOIN (VALUES ('relative'), ('full')) v(source_path)",
    ),
    "rebuild_special_orders_by_year": (
        rebuild_special_orders_by_year,
        f"{_SPECIAL} AND year(OrderDate) = 1998",
    ),
    "insert_select": (
        insert_select,
        f"SELECT CustomerNo AS CustAltKey, CustomerName, City FROM ({CUSTOMERS_SQL})",
    ),
    "insert_values": (
        insert_values,
        """SELECT c_custkey AS CustomerID, c_mktsegment AS FirstName, c_name AS LastName FROM customer
           UNION ALL SELECT -1, 'Mill', 'Race'""",
    ),
    "copy_into_staging": (
        copy_into_staging,
        f"""SELECT row_number() OVER (ORDER BY CASE WHEN Category IN ('PROMO', 'SMALL', 'LARGE') THEN 0 ELSE 1 END,
                                      ProductID) AS StockKey,
                   ProductID, ProductName, Category, CAST(ListPrice AS DOUBLE) AS ListPrice,
                   CAST(NULL AS BOOLEAN) AS Withdrawn
            FROM ({PRODUCTS_SQL})""",
    ),
    "copy_into_maxerrors": (
        copy_into_maxerrors,
        "SELECT p_partkey AS ProductID, p_name AS ProductName, p_size AS Size FROM part WHERE p_brand <> 'Brand#7'",
    ),
    "copy_into_constraints": (
        copy_into_constraints,
        """SELECT p_partkey AS ProductID, p_name AS ProductName, nullif(p_type, 'PROMO') AS Category,
                  p_type <> 'PROMO' AND length(p_name) <= 9 AS loaded FROM part""",
    ),
    "copy_into_rejects": (
        copy_into_rejects,
        f"""SELECT * FROM (
              SELECT p_name AS PartName, nullif(p_type, 'PROMO') AS Kind, CASE
                       WHEN p_brand = 'Brand#7' THEN '{tables.UNREADABLE}'
                       ELSE concat_ws('; ', CASE WHEN p_type = 'PROMO' THEN 'Kind is NULL' END,
                                      CASE WHEN length(p_name) > 9 THEN 'PartName is longer than 9' END) END AS Reasons
              FROM part) WHERE Reasons <> ''""",
    ),
    "rename_swap": (
        rename_swap,
        f"SELECT CustomerNo, lower(City) AS City, City AS OldCity FROM ({CUSTOMERS_SQL})",
    ),
    "layout_hash": (
        layout_hash,
        """SELECT o_orderstatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    ),
    "layout_round_robin": (
        layout_round_robin,
        """SELECT count(*) AS row_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, true AS even
           FROM lineitem""",
    ),
    "layout_replicate_join": (
        layout_replicate_join,
        """SELECT n_name AS City, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    ),
}
