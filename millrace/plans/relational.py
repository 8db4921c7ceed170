"""Queries: projections, filters, joins, aggregates, windows, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import date_key
from millrace.functions.text import json_paths, json_value, split_name
from millrace.operators import star
from millrace.operators.dimensions import date_bounds, date_dimension, split_parent
from millrace.operators.facts import Lookup
from millrace.operators.ranking import rank_within
from millrace.plans.inputs import (
    CUSTOMERS_SQL,
    LINE_AMOUNT_SQL,
    PRODUCTS_SQL,
    SALES_ORDERS_SQL,
    cities,
    customers,
    from_units,
    line_units,
    products,
    sales_orders,
    table,
)
from millrace.session import scratch


# ---- projections and filters ------------------------------------------------

def project_columns(spark, folder):
    df = products(spark, folder)
    return df[["ProductID", "ListPrice"]].select("ProductID", F.col("ListPrice").cast("double").alias("ListPrice"))


def project_derived_year_month(spark, folder):
    return sales_orders(spark, folder).withColumns(
        {"Year": F.year("OrderDate").cast("bigint"), "Month": F.month("OrderDate").cast("bigint")}
    )


def split_name_columns(spark, folder):
    return split_name(sales_orders(spark, folder), "CustomerName")


def rename_columns(spark, folder):
    renamed = customers(spark, folder).withColumnRenamed("CustomerNo", "CustAltKey")
    return renamed.select("CustAltKey", F.col("City").alias("CustomerCity"), "CustomerName")


def replace_values(spark, folder):
    """One segment and all negative balances blanked out, then filled again."""
    df = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    return df.fillna({"segment": "n/a", "balance": 0.0}).replace("HOUSEHOLD", "HOME", subset=["segment"])


def filter_equality(spark, folder):
    return sales_orders(spark, folder).where("OrderType = 'Urgent Order'")


def filter_in_list(spark, folder):
    df = products(spark, folder).where(F.col("Category").isin("PROMO", "ECONOMY"))
    return df.select("ProductID", "ProductName", F.col("ListPrice").cast("double").alias("ListPrice"))


def point_lookup(spark, folder):
    """One customer by number; the scan skips row groups that cannot hold it."""
    return table(spark, folder, "customer").where("c_custkey = 7").select("c_custkey", "c_name", "c_mktsegment")


# ---- star queries -----------------------------------------------------------

def _dates(spark, folder):
    return date_dimension(date_bounds(table(spark, folder, "orders"), "o_orderdate"))


def _order_amounts(spark, folder, *order_columns):
    """Sales amount per order, lines already added up, with columns of the order."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", line_units().alias("SalesUnits"))
    amounts = star.sum_by(lines, ["l_orderkey"], "SalesUnits")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", date_key(F.col("o_orderdate")).alias("OrderDateKey"), *order_columns
    )
    return amounts.join(orders, amounts.l_orderkey == orders.o_orderkey)


def _calendar(df):
    return df.withColumns(
        {c: F.col(c).cast("bigint") for c in ("CalendarYear", "CalendarQuarter") if c in df.columns}
    ).withColumn("TotalSales", from_units("SalesUnits")).drop("SalesUnits")


def star_sales_by_quarter(spark, folder):
    dates = Lookup("OrderDateKey", _dates(spark, folder), "DateKey", "DateKey")
    per_day = star.sum_by(_order_amounts(spark, folder), ["OrderDateKey"], "SalesUnits")
    totals = star.roll_up(per_day, dates, ["CalendarYear", "CalendarQuarter"], "SalesUnits")
    return _calendar(totals).orderBy("CalendarYear", "CalendarQuarter")


def star_sales_by_quarter_city(spark, folder):
    who = Lookup("o_custkey", table(spark, folder, "customer"), "c_custkey", "c_custkey")
    dates = Lookup("OrderDateKey", _dates(spark, folder), "DateKey", "DateKey")
    where = Lookup("c_nationkey", cities(spark, folder), "CityKey", "CityKey")
    # A customer rarely orders twice a day, so orders meet their customer at once.
    sales = star.roll_up(_order_amounts(spark, folder, "o_custkey"), who, ["c_nationkey"], "SalesUnits", keep=["OrderDateKey"])
    quarter = ["CalendarYear", "CalendarQuarter"]
    sales = star.roll_up(sales, dates, quarter, "SalesUnits", keep=["c_nationkey"])
    sales = star.roll_up(sales, where, ["City"], "SalesUnits", keep=quarter)
    return _calendar(sales).orderBy(*quarter, "City")


def snowflake_items_by_category(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("ProductKey"), F.col("p_type").alias("ProductCategory")
    )
    categories, dim_product = split_parent(parts, ["ProductCategory"], "CategoryKey", hashed=True)
    sales = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("ProductKey"), F.col("l_quantity").cast("bigint").alias("ItemsSold")
    )
    product = Lookup("ProductKey", dim_product, "ProductKey", "ProductKey")
    category = Lookup("CategoryKey", categories, "CategoryKey", "CategoryKey")
    items = star.roll_up(star.sum_by(sales, ["ProductKey"], "ItemsSold"), product, ["CategoryKey"], "ItemsSold")
    return star.roll_up(items, category, ["ProductCategory"], "ItemsSold").orderBy("ProductCategory")


def anti_join_unstaged(spark, folder):
    """Products whose key no staged (large) product has."""
    parts = table(spark, folder, "part")
    staged = parts.where("p_size >= 25").select("p_partkey")
    return parts.join(staged, "p_partkey", "left_anti").select("p_partkey", "p_name", "p_size")


# ---- aggregates -------------------------------------------------------------

def group_count_rows(spark, folder):
    return products(spark, folder).select("ProductID", "Category").groupBy("Category").count()


def group_count_column(spark, folder):
    """COUNT(column) skips NULLs: one brand's ids are blanked out."""
    df = table(spark, folder, "part").select(
        F.when(F.col("p_brand") != "Brand#7", F.col("p_partkey")).alias("ProductID"),
        F.col("p_type").alias("Category"),
    )
    return df.groupBy("Category").agg(F.count("ProductID").alias("ProductCount")).orderBy("Category")


def _order_years(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("CalendarYear"))


def distinct_orders_by_year(spark, folder):
    """The date depends on the order alone, so lines are reduced to distinct orders first."""
    numbers = table(spark, folder, "lineitem").select("l_orderkey").distinct()
    facts = numbers.join(_order_years(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
    return facts.groupBy("CalendarYear").agg(F.count("*").alias("Orders")).orderBy("CalendarYear")


def approx_orders_by_year(spark, folder):
    """Estimated beside exact orders. Lines are reduced to distinct orders before they meet the orders' dates."""
    numbers = table(spark, folder, "lineitem").select("l_orderkey").distinct()
    facts = numbers.join(_order_years(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
    estimate = F.approx_count_distinct("l_orderkey", star.APPROX_ERROR)
    both = facts.groupBy("CalendarYear").agg(F.count("*").alias("Orders"), estimate.alias("Estimate"))
    return both.select(
        "CalendarYear", "Orders", (star.rate(F.col("Estimate"), F.col("Orders")) <= 0.02).alias("WithinTwoPercent")
    )


def _shipped(spark, folder):
    """Order lines by the day they left: the date is the line's own, so no join is needed."""
    return table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("ShipDate"), "l_orderkey")


def _stored(spark, df, label):
    """A frame as a table kept in files, as a load would keep it for later queries."""
    df.write.parquet(path := scratch(spark, label))
    return spark.read.schema(df.schema).parquet(path)


def approx_orders_rollup(spark, folder):
    """Orders with a line shipped, per month and year, estimated from sketches stored per day.

    An order ships on several days, so counts of days do not add up; sketches do.
    """
    lines = _shipped(spark, folder)
    days = _stored(spark, star.distinct_sketches(lines, ["ShipDate"], "l_orderkey"), "sketches")
    year, month = F.year("ShipDate").cast("bigint").alias("ShipYear"), F.month("ShipDate").cast("bigint").alias("ShipMonth")
    whole = F.lit(None).cast("bigint").alias("ShipMonth")
    estimates = star.merged_sketches(days, [year, month], "Estimate").unionByName(
        star.merged_sketches(days, [year, whole], "Estimate")
    )
    exact = lines.groupBy(year, month).agg(F.count_distinct("l_orderkey").alias("Orders")).unionByName(
        lines.groupBy(year, whole).agg(F.count_distinct("l_orderkey").alias("Orders"))
    )
    same = estimates.ShipYear.eqNullSafe(exact.ShipYear) & estimates.ShipMonth.eqNullSafe(exact.ShipMonth)
    return exact.join(estimates, same).select(
        exact.ShipYear, exact.ShipMonth, "Orders", "Estimate",
        (star.rate(F.col("Estimate"), F.col("Orders")) <= 0.02).alias("WithinTwoPercent"),
    )


def distinct_orders_rollup(spark, folder):
    """Exact orders with a line shipped, per quarter and year, both from bitmaps stored per quarter."""
    lines = _shipped(spark, folder).select(
        F.year("ShipDate").cast("bigint").alias("ShipYear"), F.quarter("ShipDate").cast("bigint").alias("ShipQuarter"), "l_orderkey"
    )
    quarters = _stored(spark, star.distinct_bitmaps(lines, ["ShipYear", "ShipQuarter"], "l_orderkey"), "bitmaps")
    years = star.merged_bitmaps(quarters, ["ShipYear"], "Orders").withColumn("ShipQuarter", F.lit(None).cast("bigint"))
    return star.merged_bitmaps(quarters, ["ShipYear", "ShipQuarter"], "Orders").unionByName(years)


def sales_hierarchy_rollup(spark, folder):
    """Sales of every level of two hierarchies: all, year, quarter, month; and region, nation."""
    days = star.sum_by(_order_amounts(spark, folder, "o_custkey"), ["OrderDateKey", "o_custkey"], "SalesUnits")
    who = Lookup("o_custkey", table(spark, folder, "customer"), "c_custkey", "c_custkey")
    sales = star.roll_up(days, who, ["c_nationkey"], "SalesUnits", keep=["OrderDateKey"])
    where = Lookup("c_nationkey", cities(spark, folder), "CityKey", "CityKey")
    dates = Lookup("OrderDateKey", _dates(spark, folder), "DateKey", "DateKey")
    month = ["CalendarYear", "CalendarQuarter", "MonthOfYear"]
    sales = star.roll_up(sales, dates, month, "SalesUnits", keep=["c_nationkey"])
    # A few rows per city and month are left; both hierarchies start from them.
    sales = _stored(spark, star.roll_up(sales, where, ["CountryRegion", "City"], "SalesUnits", keep=month), "monthly")
    by_date = star.subtotals(star.sum_by(sales, month, "SalesUnits"), month, "SalesUnits")
    by_place = star.subtotals(star.sum_by(sales, ["CountryRegion", "City"], "SalesUnits"), ["CountryRegion", "City"], "SalesUnits")
    both = by_date.withColumn("Hierarchy", F.lit("date")).unionByName(
        by_place.withColumn("Hierarchy", F.lit("place")), allowMissingColumns=True
    )
    return _calendar(both).withColumn("MonthOfYear", F.col("MonthOfYear").cast("bigint"))


# ---- windows, sorts, limits -------------------------------------------------

def rank_products(spark, folder):
    df = table(spark, folder, "part").select(
        F.col("p_type").alias("ProductCategory"),
        F.col("p_partkey").alias("ProductID"),
        F.col("p_retailprice").alias("ListPrice"),
    )
    return rank_within(df, ["ProductCategory"], "ListPrice", ["ProductID"])


def revenue_by_store(spark, folder):
    """Revenue of each store and year.

    An order rarely names a store twice, so summing lines before they meet their
    order would not make them fewer; they are summed per year and store after
    it. A crowded order is split by adaptive skew handling.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", line_units().alias("Revenue"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("CalendarYear")
    )
    sales = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    revenue = star.sum_by(sales, ["CalendarYear", "l_suppkey"], "Revenue")
    stores = table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("StoreName"))
    return revenue.join(stores, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "CalendarYear", F.col("s_suppkey").alias("StoreNo"), "StoreName", "Revenue"
    )


def rank_stores_by_year(spark, folder):
    """Stores of each year by revenue; equal revenues share a rank."""
    ranked = rank_within(revenue_by_store(spark, folder), ["CalendarYear"], "Revenue", ["StoreNo"])
    return ranked.select("CalendarYear", "StoreNo", "StoreName", from_units("Revenue").alias("Revenue"), "Place")


def sort_customers(spark, folder):
    """By name; the id makes the order total and lets equal names spread over tasks."""
    return customers(spark, folder).orderBy("CustomerName", "CustomerNo")


def top_n(spark, folder):
    df = table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    return df.select("o_orderkey", "o_totalprice")


def json_value_query(spark, folder):
    df = table(spark, folder, "events")
    return df.select(
        "event_id",
        json_value(F.col("props"), "$.k").cast("bigint").alias("k"),
        json_value(F.col("props"), "$").alias("whole"),
        json_value(F.col("props"), "$.missing").alias("missing"),
    )


def json_variant_paths(spark, folder):
    """Several paths with their types out of one parse; one document of each type is nested, one is broken."""
    kind = F.col("event_type")
    document = (
        F.when(kind == "click", F.concat(F.lit('{"k": {"n": '), F.col("event_id"), F.lit(', "tags": ["a", "b"]}}')))
        .when(kind == "view", F.concat(F.lit('{"k": "'), F.col("user_id"), F.lit('", "at": {"n": 1.5}}')))
        .when(kind == "error", F.concat(F.lit('{"k": '), F.col("event_id")))
        .otherwise(F.col("props"))
    )
    events = table(spark, folder, "events").select("event_id", document.alias("document"))
    paths = {
        "k": ("$.k", "bigint"), "n": ("$.k.n", "bigint"), "tag": ("$.k.tags[1]", "string"), "at": ("$.at.n", "double"),
        "k_kind": ("$.k", "kind"),
    }
    return json_paths(events, "document", paths).drop("document")


_RANKED = """
  row_number() OVER w AS Position, rank() OVER v AS Place, dense_rank() OVER v AS Step,
  CAST(ntile(4) OVER w AS BIGINT) AS Tile"""
_RANK_WINDOWS = """
  WINDOW v AS (PARTITION BY ProductCategory ORDER BY ListPrice DESC),
         w AS (PARTITION BY ProductCategory ORDER BY ListPrice DESC, ProductID)"""

_SALES = f"""
  SELECT CAST(year(o_orderdate) AS BIGINT) AS CalendarYear, CAST(quarter(o_orderdate) AS BIGINT) AS CalendarQuarter,
         o_orderdate, o_custkey, l_orderkey, l_partkey, l_suppkey, {LINE_AMOUNT_SQL} AS SalesAmount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

QUERIES = {
    "project_columns": (
        project_columns,
        "SELECT p_partkey AS ProductID, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS ListPrice FROM part",
    ),
    "project_derived_year_month": (
        project_derived_year_month,
        f"""SELECT *, CAST(year(OrderDate) AS BIGINT) AS Year, CAST(month(OrderDate) AS BIGINT) AS Month
            FROM ({SALES_ORDERS_SQL})""",
    ),
    "split_name_columns": (
        split_name_columns,
        f"""SELECT OrderID, OrderTotal, OrderType, OrderDate, split_part(CustomerName, ' ', 1) AS FirstName,
                   nullif(split_part(CustomerName, ' ', 2), '') AS LastName FROM ({SALES_ORDERS_SQL})""",
    ),
    "rename_columns": (
        rename_columns,
        f"SELECT CustomerNo AS CustAltKey, City AS CustomerCity, CustomerName FROM ({CUSTOMERS_SQL})",
    ),
    "replace_values": (
        replace_values,
        """SELECT c_custkey,
                  CASE c_mktsegment WHEN 'MACHINERY' THEN 'n/a' WHEN 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS segment,
                  CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS balance
           FROM customer""",
    ),
    "filter_equality": (filter_equality, f"SELECT * FROM ({SALES_ORDERS_SQL}) WHERE OrderType = 'Urgent Order'"),
    "filter_in_list": (
        filter_in_list,
        f"""SELECT ProductID, ProductName, CAST(ListPrice AS DOUBLE) AS ListPrice FROM ({PRODUCTS_SQL})
            WHERE Category IN ('PROMO', 'ECONOMY')""",
    ),
    "point_lookup": (point_lookup, "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey = 7"),
    "star_sales_by_quarter": (
        star_sales_by_quarter,
        f"""SELECT CalendarYear, CalendarQuarter, CAST(sum(SalesAmount) AS DOUBLE) AS TotalSales
            FROM ({_SALES}) GROUP BY ALL ORDER BY ALL""",
    ),
    "star_sales_by_quarter_city": (
        star_sales_by_quarter_city,
        f"""SELECT CalendarYear, CalendarQuarter, n_name AS City, CAST(sum(SalesAmount) AS DOUBLE) AS TotalSales
            FROM ({_SALES}) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            GROUP BY ALL ORDER BY ALL""",
    ),
    "snowflake_items_by_category": (
        snowflake_items_by_category,
        """SELECT p_type AS ProductCategory, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS ItemsSold
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL ORDER BY ALL""",
    ),
    "anti_join_unstaged": (
        anti_join_unstaged,
        """SELECT p_partkey, p_name, p_size FROM part p WHERE NOT EXISTS
           (SELECT * FROM (SELECT * FROM part WHERE p_size >= 25) s WHERE s.p_partkey = p.p_partkey)""",
    ),
    "group_count_rows": (group_count_rows, "SELECT p_type AS Category, count(*) AS count FROM part GROUP BY ALL"),
    "group_count_column": (
        group_count_column,
        """SELECT p_type AS Category, count(CASE WHEN p_brand <> 'Brand#7' THEN p_partkey END) AS ProductCount
           FROM part GROUP BY ALL ORDER BY ALL""",
    ),
    "distinct_orders_by_year": (
        distinct_orders_by_year,
        f"SELECT CalendarYear, count(DISTINCT l_orderkey) AS Orders FROM ({_SALES}) GROUP BY ALL ORDER BY ALL",
    ),
    "approx_orders_by_year": (
        approx_orders_by_year,
        f"""SELECT CalendarYear, count(DISTINCT l_orderkey) AS Orders, true AS WithinTwoPercent
            FROM ({_SALES}) GROUP BY CalendarYear""",
    ),
    # Estimates are beyond SQL; tests compare the exact figures and the bound.
    "approx_orders_rollup": (approx_orders_rollup, None),
    "distinct_orders_rollup": (
        distinct_orders_rollup,
        """SELECT CAST(year(l_shipdate) AS BIGINT) AS ShipYear, CAST(quarter(l_shipdate) AS BIGINT) AS ShipQuarter,
                  count(DISTINCT l_orderkey) AS Orders FROM lineitem GROUP BY GROUPING SETS ((1, 2), (1))""",
    ),
    "sales_hierarchy_rollup": (
        sales_hierarchy_rollup,
        f"""WITH sales AS (
              SELECT CalendarYear, CalendarQuarter, CAST(month(o_orderdate) AS BIGINT) AS MonthOfYear, r_name AS CountryRegion,
                     n_name AS City, SalesAmount
              FROM ({_SALES}) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)
            SELECT 'date' AS Hierarchy, 3 - bit_count(GROUPING_ID(CalendarYear, CalendarQuarter, MonthOfYear))::BIGINT AS Level,
                   CalendarYear, CalendarQuarter, MonthOfYear, NULL::VARCHAR AS CountryRegion, NULL::VARCHAR AS City,
                   CAST(sum(SalesAmount) AS DOUBLE) AS TotalSales
            FROM sales GROUP BY ROLLUP (CalendarYear, CalendarQuarter, MonthOfYear)
            UNION ALL
            SELECT 'place', 2 - bit_count(GROUPING_ID(CountryRegion, City))::BIGINT, NULL, NULL, NULL, CountryRegion, City,
                   CAST(sum(SalesAmount) AS DOUBLE)
            FROM sales GROUP BY ROLLUP (CountryRegion, City)""",
    ),
    "rank_products": (
        rank_products,
        f"""SELECT *, {_RANKED}
            FROM (SELECT p_type AS ProductCategory, p_partkey AS ProductID, p_retailprice AS ListPrice FROM part)
            {_RANK_WINDOWS}""",
    ),
    "rank_stores_by_year": (
        rank_stores_by_year,
        f"""SELECT CalendarYear, StoreNo, StoreName, CAST(Revenue AS DOUBLE) AS Revenue,
                   rank() OVER (PARTITION BY CalendarYear ORDER BY Revenue DESC) AS Place
            FROM (SELECT CalendarYear, s_suppkey AS StoreNo, s_name AS StoreName, sum(SalesAmount) AS Revenue
                  FROM ({_SALES}) JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)""",
    ),
    "sort_customers": (sort_customers, f"SELECT * FROM ({CUSTOMERS_SQL}) ORDER BY CustomerName, CustomerNo"),
    "top_n": (top_n, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"),
    "json_variant_paths": (
        json_variant_paths,
        """WITH events AS (
             SELECT event_id, CASE event_type
                      WHEN 'click' THEN '{"k": {"n": ' || event_id || ', "tags": ["a", "b"]}}'
                      WHEN 'view' THEN '{"k": "' || user_id || '", "at": {"n": 1.5}}'
                      WHEN 'error' THEN '{"k": ' || event_id ELSE props END AS document FROM events),
           good AS (SELECT event_id, CASE WHEN json_valid(document) THEN document END AS d FROM events)
           SELECT event_id, TRY_CAST(json_extract_string(d, '$.k') AS BIGINT) AS k,
                  CAST(json_extract_string(d, '$.k.n') AS BIGINT) AS n, json_extract_string(d, '$.k.tags[1]') AS tag,
                  CAST(json_extract_string(d, '$.at.n') AS DOUBLE) AS at,
                  CASE json_type(d, '$.k') WHEN 'OBJECT' THEN 'OBJECT' WHEN 'VARCHAR' THEN 'STRING'
                       WHEN 'UBIGINT' THEN 'BIGINT' END AS k_kind
           FROM good""",
    ),
    "json_value": (
        json_value_query,
        """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                  CAST(NULL AS VARCHAR) AS whole, json_extract_string(props, '$.missing') AS missing FROM events""",
    ),
}
