"""Queries: every way of reading files. The files are written from the tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.paths import filepath
from millrace.functions.text import json_value
from millrace.plans.inputs import (
    CUSTOMERS_SQL,
    PRODUCTS_SQL,
    SALES_ORDERS_SQL,
    customers,
    new_database,
    products,
    sales_orders,
    table,
)
from millrace.session import scratch
from millrace.sinks.folders import gathered
from millrace.sources import rowsets
from millrace.sources.lake import Lake, delimited_format, parquet_format

PRODUCT_SCHEMA = "ProductID BIGINT, ProductName STRING, Category STRING, ListPrice FLOAT"


def write_csv(df, header=True, **options):
    """Write CSV files with doubled inner quotes to a new folder."""
    path = scratch(df.sparkSession, "csv")
    df.write.options(header=header, escape='"', **options).csv(path)
    return path


def _as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def scan_csv_header(spark, folder):
    return rowsets.untyped(spark, write_csv(products(spark, folder)))


def scan_csv_schema(spark, folder):
    path = write_csv(products(spark, folder), header=False)
    df = spark.read.load(path, format="csv", schema=PRODUCT_SCHEMA, header=False)
    return _as_double(df, "ListPrice")


def scan_csv_infer(spark, folder):
    path = write_csv(sales_orders(spark, folder))
    return spark.read.csv(f"{path}/*.csv", header=True, inferSchema=True).withColumn(
        "OrderID", F.col("OrderID").cast("bigint")
    )


def scan_csv_skip_first(spark, folder):
    path = write_csv(products(spark, folder))
    df = rowsets.delimited(spark, path, schema="id BIGINT, name STRING, category STRING, price DOUBLE", first_row=2)
    return df.select("id", "name", "price")


def scan_csv_header_row(spark, folder):
    path = write_csv(products(spark, folder))
    df = rowsets.delimited(spark, f"{path}/*.csv", header_row=True)
    return df.withColumn("ProductID", F.col("ProductID").cast("bigint"))


def scan_csv_dialect(spark, folder):
    """Tab-separated, single-quoted fields that hold tabs and quotes, Windows line ends."""
    tricky = table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_name", F.lit("\t"), F.lit("'"), "p_brand", F.lit("'")).alias("p_label"),
        "p_size",
    )
    line = F.to_csv(F.struct("*"), {"sep": "\t", "quote": "'", "escape": "'"})
    path = scratch(spark, "dialect")
    tricky.select(F.concat(line, F.lit("\r"))).write.text(path)
    return rowsets.delimited(
        spark,
        path,
        schema="p_partkey BIGINT, p_label STRING, p_size INT",
        field_terminator="\t",
        field_quote="'",
    )


def scan_csv_schema_override(spark, folder):
    path = write_csv(products(spark, folder).select("ProductID", "ProductName", "ListPrice"))
    df = rowsets.delimited(
        spark, path, schema="product_id BIGINT, product_name STRING, list_price DECIMAL(5,2)", first_row=2
    )
    fits = F.length("product_name") <= 20
    return _as_double(df, "list_price").withColumn("name_fits", fits)


def scan_path_patterns(spark, folder):
    """The same tree read through four patterns; rows counted per pattern."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    root = scratch(spark, "tree")
    orders.where("o_orderstatus = 'F'").write.csv(root)
    orders.where("o_orderstatus = 'O'").write.csv(f"{root}/archive")
    orders.where("o_orderstatus = 'P'").write.csv(f"{root}/archive/older")
    patterns = {
        "one path": f"{root}/archive",
        "prefix": f"{root}/part-*",
        "all in folder": f"{root}/*",
        "all below": f"{root}/**",
    }
    counts = [
        rowsets.delimited(spark, path, schema="o_orderkey BIGINT, o_orderstatus STRING").agg(
            F.lit(name).alias("pattern"), F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum")
        )
        for name, path in patterns.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def scan_json_docs(spark, folder):
    """Pretty-printed documents, read whole and taken apart by path."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("list_price"),
    )
    path = scratch(spark, "documents")
    pretty = F.to_json(F.struct("*"), {"pretty": "true"})
    parts.select(pretty).write.option("lineSep", rowsets.DOCUMENT_END).text(path)
    return rowsets.documents(spark, path).select(
        json_value(F.col("doc"), "$.product_id").cast("bigint").alias("product_id"),
        json_value(F.col("doc"), "$.product_name").alias("product"),
        json_value(F.col("doc"), "$.list_price").cast("double").alias("price"),
    )


def scan_parquet(spark, folder):
    return rowsets.parquet(spark, f"{folder}/customer.parquet")


def _partitioned_orders(spark, folder):
    root = scratch(spark, "partitioned")
    dated = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    gathered(dated, ["year", "month"]).write.partitionBy("year", "month").parquet(root)
    return root


def scan_partition_filepath(spark, folder):
    """January and February of one year, chosen by the folder names in the file path."""
    root = _partitioned_orders(spark, folder)
    pattern = f"{root}/year=*/month=*/*"
    df = spark.read.parquet(root)
    picked = df.where((filepath(pattern, 1) == "1996") & filepath(pattern, 2).isin("1", "2"))
    return picked.select(
        "o_orderkey", "o_totalprice", filepath(pattern, 1).alias("year_folder"), filepath(pattern, 2).alias("month_folder")
    )


def scan_leaf_partition(spark, folder):
    root = _partitioned_orders(spark, folder)
    df = rowsets.partition_folder(spark, root, "year=1997")
    return df.withColumns({"year": F.col("year").cast("bigint"), "month": F.col("month").cast("bigint")})


def scan_named_source(spark, folder):
    lake = Lake(spark)
    lake.create_source("files", scratch(spark, "lake"))
    lake.create_format("CsvFormat", delimited_format())
    lake.write(sales_orders(spark, folder), "orders", "files", "CsvFormat", header="true")
    df = lake.read("orders/*.csv", "files", "CsvFormat", header="true", inferSchema="true")
    return df.withColumn("OrderID", F.col("OrderID").cast("bigint"))


def scan_named_format(spark, folder):
    """One preset for writing and reading, delimited and compressed Parquet."""
    lake = Lake(spark)
    lake.create_source("files", scratch(spark, "lake"))
    lake.create_format("PipeFormat", delimited_format("|", "'"))
    lake.create_format("ParquetFormat", parquet_format())
    df = products(spark, folder)
    lake.write(df, "text", "files", "PipeFormat")
    lake.write(df, "columnar", "files", "ParquetFormat")
    text = lake.read("text", "files", "PipeFormat", schema="ProductID BIGINT, ProductName STRING, Category STRING, ListPrice DECIMAL(18,2)")
    both = text.withColumn("stored_as", F.lit("text")).unionByName(
        lake.read("columnar", "files", "ParquetFormat").withColumn("stored_as", F.lit("parquet"))
    )
    return _as_double(both, "ListPrice")


def external_table_scan(spark, folder):
    lake = Lake(spark)
    lake.create_source("files", scratch(spark, "lake"))
    lake.create_format("CsvFormat", delimited_format())
    lake.write(products(spark, folder), "products", "files", "CsvFormat")
    columns = "product_id BIGINT, product_name STRING, category STRING, list_price DECIMAL(18,2)"
    name = f"{new_database(spark)}.products"
    lake.external_table(name, columns, "products/*.csv", "files", "CsvFormat")
    return spark.sql(f"SELECT product_id, product_name, CAST(list_price AS DOUBLE) AS list_price FROM {name}")


def catalog_scan(spark, folder):
    name = f"{new_database(spark)}.Customer"
    customers(spark, folder).write.saveAsTable(name)
    return spark.table(name).select("CustomerNo", "CustomerName", "City").orderBy("CustomerName", "CustomerNo")


_PRODUCTS_DOUBLE = f"SELECT ProductID, ProductName, Category, CAST(ListPrice AS DOUBLE) AS ListPrice FROM ({PRODUCTS_SQL})"

QUERIES = {
    "scan_csv_header": (
        scan_csv_header,
        f"""SELECT CAST(ProductID AS VARCHAR) AS ProductID, ProductName, Category,
                   CAST(ListPrice AS VARCHAR) AS ListPrice FROM ({PRODUCTS_SQL})""",
    ),
    "scan_csv_schema": (
        scan_csv_schema,
        f"""SELECT ProductID, ProductName, Category, CAST(CAST(ListPrice AS FLOAT) AS DOUBLE) AS ListPrice
            FROM ({PRODUCTS_SQL})""",
    ),
    "scan_csv_infer": (scan_csv_infer, SALES_ORDERS_SQL),
    "scan_csv_skip_first": (
        scan_csv_skip_first,
        f"""SELECT ProductID AS id, ProductName AS name, CAST(ListPrice AS DOUBLE) AS price FROM ({PRODUCTS_SQL})""",
    ),
    "scan_csv_header_row": (scan_csv_header_row, _PRODUCTS_DOUBLE),
    "scan_csv_dialect": (
        scan_csv_dialect,
        "SELECT p_partkey, p_name || chr(9) || '''' || p_brand || '''' AS p_label, p_size FROM part",
    ),
    "scan_csv_schema_override": (
        scan_csv_schema_override,
        f"""SELECT ProductID AS product_id, ProductName AS product_name, CAST(ListPrice AS DOUBLE) AS list_price,
                   length(ProductName) <= 20 AS name_fits FROM ({PRODUCTS_SQL})""",
    ),
    "scan_path_patterns": (
        scan_path_patterns,
        """SELECT pattern, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
           FROM orders JOIN (VALUES ('one path', 'O'), ('prefix', 'F'), ('all in folder', 'F'), ('all below', 'F'),
                                    ('all below', 'O'), ('all below', 'P')) v(pattern, status)
             ON o_orderstatus = status
           GROUP BY pattern""",
    ),
    "scan_json_docs": (
        scan_json_docs,
        "SELECT p_partkey AS product_id, p_name AS product, p_retailprice AS price FROM part",
    ),
    "scan_parquet": (scan_parquet, "SELECT * FROM customer"),
    "scan_partition_filepath": (
        scan_partition_filepath,
        """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS VARCHAR) AS year_folder,
                  CAST(month(o_orderdate) AS VARCHAR) AS month_folder
           FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) IN (1, 2)""",
    ),
    "scan_leaf_partition": (
        scan_leaf_partition,
        """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS year,
                  CAST(month(o_orderdate) AS BIGINT) AS month
           FROM orders WHERE year(o_orderdate) = 1997""",
    ),
    "scan_named_source": (scan_named_source, SALES_ORDERS_SQL),
    "scan_named_format": (
        scan_named_format,
        f"SELECT p.*, stored_as FROM ({_PRODUCTS_DOUBLE}) p CROSS JOIN (VALUES ('text'), ('parquet')) v(stored_as)",
    ),
    "external_table_scan": (
        external_table_scan,
        f"""SELECT ProductID AS product_id, ProductName AS product_name, CAST(ListPrice AS DOUBLE) AS list_price
            FROM ({PRODUCTS_SQL})""",
    ),
    "catalog_scan": (
        catalog_scan,
        f"SELECT CustomerNo, CustomerName, City FROM ({CUSTOMERS_SQL}) ORDER BY CustomerName, CustomerNo",
    ),
}
