"""Queries: databases, views and table definitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.catalog.tables import (
    TableBuilder,
    create_or_replace_table,
    create_table,
    create_table_if_missing,
    register_folder,
    using,
)
from millrace.files import Files
from millrace.plans.inputs import (
    CUSTOMERS_SQL,
    PRODUCTS_SQL,
    SALES_ORDERS_SQL,
    customers,
    new_database,
    products,
    sales_orders,
)
from millrace.session import scratch
from millrace.sinks import tables


def database_scope(spark, folder):
    """A bare table name means the database in use; the session gets its own one back."""
    database = new_database(spark)
    with using(spark, database):
        tables.save_managed(customers(spark, folder), "Customer")
        inside = spark.sql("SELECT current_database() AS name").first().name == database
    after = spark.catalog.currentDatabase() != database
    return spark.table(f"{database}.Customer").withColumns({"was_inside": F.lit(inside), "left_again": F.lit(after)})


def create_table_schema(spark, folder):
    name = f"{new_database(spark)}.OrderBook"
    create_table(
        spark, name, "OrderId BIGINT NOT NULL, OrderDate DATE NOT NULL, CustomerName STRING, SalesTotal FLOAT NOT NULL"
    )
    rows = sales_orders(spark, folder).withColumnRenamed("OrderID", "OrderId")
    rows = rows.withColumn("SalesTotal", F.col("OrderTotal").cast("float"))
    tables.insert_checked(rows, name, not_null=["OrderId", "OrderDate", "SalesTotal"], max_lengths={"CustomerName": 80})
    return spark.table(name).withColumn("SalesTotal", F.col("SalesTotal").cast("double"))


def create_table_builder(spark, folder):
    name = f"{new_database(spark)}.PriceList"
    builder = TableBuilder(spark, name).column("ProductId", "BIGINT").column("ProductName", "STRING")
    builder.column("Category", "STRING").column("Price", "FLOAT").create()
    products(spark, folder).withColumn("ListPrice", F.col("ListPrice").cast("float")).write.insertInto(name)
    return spark.table(name).withColumn("Price", F.col("Price").cast("double"))


def create_table_guards(spark, folder):
    """What each way of creating an existing table does to its rows."""
    database, columns = new_database(spark), "CustomerNo BIGINT, City STRING"
    ways = {"plain": create_table, "if_missing": create_table_if_missing, "or_replace": create_or_replace_table}
    result = None
    for way, create in ways.items():
        name = f"{database}.{way}"
        create(spark, name, columns)
        customers(spark, folder).select("CustomerNo", "City").write.insertInto(name)
        try:
            create(spark, name, columns)
            refused = False
        except AnalysisException:
            refused = True
        rows = spark.table(name).agg(
            F.lit(way).alias("way"), F.lit(refused).alias("refused"), F.count("*").alias("row_count")
        )
        result = result.unionByName(rows) if result else rows
    return result


def register_location(spark, folder):
    path = scratch(spark, "known")
    sales_orders(spark, folder).write.parquet(path)
    return register_folder(spark, f"{new_database(spark)}.KnownFiles", path)


def create_table_empty(spark, folder):
    """Created empty at a location of its own, filled later."""
    name, path = f"{new_database(spark)}.customers", scratch(spark, "empty")
    rows = customers(spark, folder)
    empty = spark.catalog.createTable(name, path=path, source="parquet", schema=rows.schema)
    was_empty = empty.isEmpty()
    rows.write.insertInto(name)
    return spark.table(name).withColumn("was_empty", F.lit(was_empty))


def drop_external_keeps_files(spark, folder):
    name, path = f"{new_database(spark)}.sales_orders", scratch(spark, "kept")
    tables.save_external(sales_orders(spark, folder), name, path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path).withColumn("in_catalog", F.lit(spark.catalog.tableExists(name)))


def drop_managed_removes_files(spark, folder):
    database = new_database(spark)
    rows = customers(spark, folder)
    tables.save_managed(rows, f"{database}.customers")
    path = _location(spark, f"{database}.customers")
    there = Files(spark, path).exists()
    spark.sql(f"DROP TABLE {database}.customers")
    left = Files(spark, path).exists()
    return rows.agg(F.count("*").alias("row_count")).withColumns(
        {"files_before": F.lit(there), "files_after": F.lit(left)}
    )


def _location(spark, name):
    described = spark.sql(f"DESCRIBE FORMATTED {name}")
    return described.where("col_name = 'Location'").first().data_type


def temp_view_sql(spark, folder):
    products(spark, folder).createOrReplaceTempView("millrace_products")
    bikes = spark.sql(
        "SELECT ProductID, ProductName, CAST(ListPrice AS DOUBLE) AS ListPrice FROM millrace_products "
        "WHERE Category IN ('STANDARD', 'MEDIUM')"
    )
    spark.catalog.dropTempView("millrace_products")
    return bikes


QUERIES = {
    "database_scope": (
        database_scope,
        f"SELECT *, true AS was_inside, true AS left_again FROM ({CUSTOMERS_SQL})",
    ),
    "create_table_schema": (
        create_table_schema,
        f"""SELECT OrderID AS OrderId, OrderDate, CustomerName, CAST(CAST(OrderTotal AS FLOAT) AS DOUBLE) AS SalesTotal
            FROM ({SALES_ORDERS_SQL})""",
    ),
    "create_table_builder": (
        create_table_builder,
        f"""SELECT ProductID AS ProductId, ProductName, Category, CAST(CAST(ListPrice AS FLOAT) AS DOUBLE) AS Price
            FROM ({PRODUCTS_SQL})""",
    ),
    "create_table_guards": (
        create_table_guards,
        """SELECT way, refused, count(c_custkey) AS row_count
           FROM (VALUES ('plain', true, true), ('if_missing', false, true), ('or_replace', false, false)) v(way, refused, kept)
           LEFT JOIN customer ON kept GROUP BY way, refused""",
    ),
    "register_location": (register_location, SALES_ORDERS_SQL),
    "create_table_empty": (create_table_empty, f"SELECT *, true AS was_empty FROM ({CUSTOMERS_SQL})"),
    "drop_external_keeps_files": (
        drop_external_keeps_files,
        f"SELECT *, false AS in_catalog FROM ({SALES_ORDERS_SQL})",
    ),
    "drop_managed_removes_files": (
        drop_managed_removes_files,
        "SELECT count(*) AS row_count, true AS files_before, false AS files_after FROM customer",
    ),
    "temp_view_sql": (
        temp_view_sql,
        f"""SELECT ProductID, ProductName, CAST(ListPrice AS DOUBLE) AS ListPrice FROM ({PRODUCTS_SQL})
            WHERE Category IN ('STANDARD', 'MEDIUM')""",
    ),
}
