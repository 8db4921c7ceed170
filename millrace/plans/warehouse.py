"""Queries: loading dimensions and facts, and the checks a load runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.dates import date_key
from millrace.operators import dimensions, keymap, quality
from millrace.operators.facts import Lookup, as_of, matched, point_in_time, replace_keys, unmatched
from millrace.operators.keys import append_members, new_members
from millrace.plans.inputs import CUSTOMERS_SQL, cities, customers, money, new_database, order_heads, order_lines, table
from millrace.session import scratch
from millrace.sinks import tables

PRODUCT_COLUMNS = {"ProductID": "StockCode", "ProductName": "ProductName", "ProductCategory": "ProductCategory", "ListPrice": "ListPrice"}
CHANGED_ON = dt.date(1998, 7, 1)
FIRST_DAY = dt.date(1990, 1, 1)


def _staged_products(spark, folder, only="true"):
    return table(spark, folder, "part").where(only).select(
        F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("ProductID"),
        F.concat_ws(", ", "p_name", "p_brand").alias("ProductName"),
        F.col("p_type").alias("ProductCategory"),
        money("p_retailprice").alias("ListPrice"),
    )


def _dim_product(spark, folder, only="true"):
    return dimensions.full_load(_staged_products(spark, folder, only), PRODUCT_COLUMNS, "StockCode", "StockKey")


def _as_double(df, column="ListPrice"):
    return df.withColumn(column, F.col(column).cast("double"))


def surrogate_key_full(spark, folder):
    return _as_double(_dim_product(spark, folder))


def _mapped(staged):
    return staged.select(*[F.col(a).alias(b) for a, b in PRODUCT_COLUMNS.items()])


def dim_append_identity(spark, folder):
    """Small products are loaded first; the next batch brings all, only unknown ones are added."""
    dimension = _dim_product(spark, folder, "p_size <= 35")
    staged = _mapped(_staged_products(spark, folder))
    added = append_members(dimension, new_members(staged, dimension, ["StockCode"]), ["StockCode"], "StockKey")
    return _as_double(dimension.unionByName(added))


def dim_upsert_rebuild(spark, folder):
    """Rebuilt beside the old table and swapped in; keys of known products survive."""
    database = new_database(spark)
    tables.save_managed(_dim_product(spark, folder, "p_size <= 35"), f"{database}.DimProduct")
    staged = _mapped(_staged_products(spark, folder, "p_size >= 25")).withColumn(
        "ListPrice", (F.col("ListPrice") + 10).cast("decimal(18,2)")
    )
    rebuilt = dimensions.upsert(spark.table(f"{database}.DimProduct"), staged, "StockCode", "StockKey")
    tables.save_managed(rebuilt, f"{database}.ProductsNext")
    tables.swap(spark, f"{database}.DimProduct", f"{database}.ProductsNext", f"{database}.ProductsBefore")
    return _as_double(spark.table(f"{database}.DimProduct"))


def _sources(spark, folder):
    """Parties of two systems whose numbers overlap; one segment is listed again, later and with another city."""
    who = customers(spark, folder)
    old, new = F.lit("1997-01-01").cast("date"), F.lit("1998-01-01").cast("date")
    shop = who.select(F.lit("shop").alias("Origin"), F.col("CustomerNo").alias("PartyNo"), F.col("CustomerName").alias("PartyName"), "City", old.alias("Since"))
    again = who.where("Segment = 'BUILDING'").select(
        F.lit("shop"), "CustomerNo", "CustomerName", F.concat(F.lit("NEW "), "City"), new
    )
    suppliers = table(spark, folder, "supplier").join(cities(spark, folder), F.col("s_nationkey") == F.col("CityKey"))
    return shop.union(again), suppliers.select(F.lit("supply").alias("Origin"), F.col("s_suppkey").alias("PartyNo"), F.col("s_name").alias("PartyName"), "City", old.alias("Since"))


def dim_multi_source(spark, folder):
    """The shop is loaded first, then both systems: equal numbers are different parties, known ones keep their keys."""
    shop, supply = _sources(spark, folder)
    empty = spark.createDataFrame([], "PartyKey bigint, Origin string, PartyNo bigint")
    first = keymap.extended_map(empty, shop, "Origin", "PartyNo", "PartyKey")
    members = keymap.resolve(shop.unionByName(supply), "Origin", "PartyNo", F.col("Since"))
    members.write.parquet(path := scratch(spark, "members"))
    members = spark.read.schema(members.schema).parquet(path)
    known = keymap.extended_map(first, members, "Origin", "PartyNo", "PartyKey")
    return keymap.integrated(known, members, "Origin", "PartyNo")


def dim_multi_source_conflicts(spark, folder):
    """What the load of several sources reports."""
    return keymap.conflicts(dim_multi_source(spark, folder))


# ---- calendars --------------------------------------------------------------

def dim_date_build(spark, folder):
    return dimensions.date_dimension(dimensions.date_bounds(table(spark, folder, "orders"), "o_orderdate"))


def dim_date_extend(spark, folder):
    """From the order dates on to the newest ship date."""
    dimension = dim_date_build(spark, folder)
    return dimensions.extend_date_dimension(dimension, table(spark, folder, "lineitem"), "l_shipdate")


def dim_time_hour_build(spark, folder):
    """Every hour between the first and the last event."""
    first, last = table(spark, folder, "events").agg(F.min("ts"), F.max("ts")).first()
    return dimensions.time_dimension(spark, first, last).select(
        "TimeKey", "DateAltKey", F.col("HourOfDay").cast("bigint").alias("HourOfDay")
    )


# ---- history ----------------------------------------------------------------

def _moved(spark, folder):
    """Customers as they are after one segment moved to another city."""
    city = F.when(F.col("Segment") == "BUILDING", F.concat(F.lit("NEW "), "City")).otherwise(F.col("City"))
    return customers(spark, folder).select("CustomerNo", "CustomerName", city.alias("City"))


def _history(spark, folder):
    """First load without one segment; then everybody, with the moves."""
    known = customers(spark, folder).where("Segment <> 'MACHINERY'").select("CustomerNo", "CustomerName", "City")
    dimension = dimensions.start_history(known, "CustomerNo", "CustomerKey", FIRST_DAY)
    return dimensions.keep_history(dimension, _moved(spark, folder), "CustomerNo", "CustomerKey", CHANGED_ON)


def dim_scd2(spark, folder):
    return _history(spark, folder)


def fact_point_in_time_key(spark, folder):
    """Each order counts for the customer row valid on its date; none before a late customer's first."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("OrderDate"))
    path = scratch(spark, "dimension")
    _history(spark, folder).write.parquet(path)
    lookup = Lookup("o_custkey", spark.read.parquet(path), "CustomerNo", "CustomerKey")
    return point_in_time(orders, F.col("OrderDate"), lookup)


def _late_changes(spark, folder):
    """Changes of many kinds: several in one load, before other rows, on the day a row began, without effect."""
    city = F.col("City")
    east = F.concat(F.lit("EAST "), city)
    changes = {
        "HOUSEHOLD": [("1996-03-01", east), ("1997-05-01", east), ("1998-01-01", city), ("1999-09-09", F.upper(east))],
        "BUILDING": [("1995-01-15", east), ("1998-07-01", city)],
        "FURNITURE": [("1990-01-01", east)],
        "AUTOMOBILE": [("1997-01-01", city)],
        "MACHINERY": [("1997-02-03", east)],
    }
    rows = F.coalesce(*[
        F.when(F.col("Segment") == segment, F.array(*[F.struct(F.lit(day).cast("date").alias("ChangedOn"), c.alias("City")) for day, c in of]))
        for segment, of in changes.items()
    ])
    return customers(spark, folder).select("CustomerNo", "CustomerName", F.inline(rows))


def _late_history(spark, folder):
    path = scratch(spark, "dimension")
    _history(spark, folder).write.parquet(path)
    return dimensions.split_history(
        spark.read.parquet(path), _late_changes(spark, folder), "CustomerNo", "CustomerKey", "ChangedOn"
    )


def dim_scd2_late(spark, folder):
    return _late_history(spark, folder)


def fact_as_of_key(spark, folder):
    """Each order with the customer row valid on its date, by one pass in order of customer and day."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("OrderDate"))
    lookup = Lookup("o_custkey", _late_history(spark, folder), "CustomerNo", "CustomerKey")
    return as_of(orders, F.col("OrderDate"), lookup)


def dim_snowflake_split(spark, folder):
    """Address columns moved to a parent; one city is unknown (NULL) and still matched."""
    source = customers(spark, folder).withColumn("City", F.nullif("City", F.lit("NATION_3")))
    geography, slim = dimensions.split_parent(source, ["City", "CountryRegion"], "GeographyKey")
    return slim.join(geography, "GeographyKey")


# ---- facts ------------------------------------------------------------------

def _keyed_sales(spark, folder, parts):
    """Order lines with the keys of their dimensions, NULL where one is unknown."""
    who = dimensions.full_load(customers(spark, folder), {"CustomerNo": "CustAltKey"}, "CustAltKey", "CustomerKey")
    what = dimensions.full_load(parts, {"p_partkey": "StockCode"}, "StockCode", "ProductKey")
    stores = table(spark, folder, "supplier")
    where = dimensions.full_load(stores, {"s_suppkey": "StoreAltKey"}, "StoreAltKey", "StoreKey")
    # The customer belongs to the order: looked up there, before orders meet their
    # several lines.
    orders = replace_keys(order_heads(spark, folder), [Lookup("CustomerNo", who, "CustAltKey", "CustomerKey")])
    orders = orders.withColumn("OrderDateKey", date_key(F.col("OrderDate"))).drop("OrderDate")
    keyed = replace_keys(
        order_lines(spark, folder).join(orders, "OrderNumber"),
        [
            Lookup("ProductID", what, "StockCode", "ProductKey"),
            Lookup("StoreNo", where, "StoreAltKey", "StoreKey"),
        ],
    ).withColumn("OrderNumber", F.col("OrderNumber").cast("string"))
    money_columns = ("UnitPrice", "Discount", "Tax", "SalesAmount")
    return keyed.withColumns({c: F.col(c).cast("double") for c in money_columns})


_SALES_KEYS = ["CustomerKey", "ProductKey", "StoreKey"]


def fact_sales_build(spark, folder):
    return matched(_keyed_sales(spark, folder, table(spark, folder, "part")), _SALES_KEYS)


def fact_sales_rejects(spark, folder):
    """The lines a load leaves out while the large products are not in their dimension yet."""
    return unmatched(_keyed_sales(spark, folder, table(spark, folder, "part").where("p_size <= 40")), _SALES_KEYS)


def dim_time_minute_build(spark, folder):
    """Every minute between the first and the last event."""
    first, last = table(spark, folder, "events").agg(F.min("ts"), F.max("ts")).first()
    return dimensions.time_dimension(spark, first, last, 60).select(
        "TimeKey", "DateAltKey", *[F.col(c).cast("bigint").alias(c) for c in ("HourOfDay", "MinuteOfHour")]
    )


# ---- checks -----------------------------------------------------------------

def check_unique(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_referential(spark, folder):
    """Lines whose product is not in a dimension of small products."""
    known = table(spark, folder, "part").where("p_size <= 40")
    return quality.orphan_keys(table(spark, folder, "lineitem"), "l_partkey", known, "p_partkey")


def check_not_null(spark, folder):
    df = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    return quality.null_counts(df, df.columns)


def check_length(spark, folder):
    """Long names per column, and prices that DECIMAL(5,2) cannot hold."""
    df = _staged_products(spark, folder)
    lengths = quality.length_violations(df, {"ProductName": 20, "ProductCategory": 5, "ProductID": 13})
    scaled = df.withColumn("Scaled", F.col("ListPrice") * F.lit("1.05").cast("decimal(4,2)"))
    prices = scaled.agg(
        F.lit("ListPrice").alias("column_name"),
        F.lit(5).cast("bigint").alias("max_length"),
        F.count_if(~quality.fits_decimal("Scaled", 5, 2)).alias("violations"),
    )
    return lengths.unionByName(prices)


_STAGED = """
  SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS StockCode, p_name || ', ' || p_brand AS ProductName,
         p_type AS ProductCategory, CAST(p_retailprice AS DECIMAL(18,2)) AS ListPrice, p_size
  FROM part"""
_KEYED = f"SELECT row_number() OVER (ORDER BY StockCode) AS StockKey, * FROM ({_STAGED}) WHERE p_size <= 35"
_ARRIVED = f"""
  SELECT (SELECT count(*) FROM part WHERE p_size <= 35) + row_number() OVER (ORDER BY StockCode) AS StockKey, *
  FROM ({_STAGED}) WHERE p_size > 35"""


def _calendar(first: str, last: str) -> str:
    return f"""
      SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS DateAltKey,
             CAST(day(d) AS INT) AS DayOfMonth, CAST(dayofweek(d) + 1 AS INT) AS DayOfWeek, dayname(d) AS DayName,
             CAST(month(d) AS INT) AS MonthOfYear, monthname(d) AS MonthName, CAST(quarter(d) AS INT) AS CalendarQuarter,
             CAST(year(d) AS INT) AS CalendarYear, CAST((month(d) + 5) % 12 // 3 + 1 AS INT) AS FiscalQuarter,
             CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS INT) AS FiscalYear
      FROM (SELECT unnest(generate_series(({first}), ({last}), INTERVAL 1 DAY)) AS d)"""


_FIRST_ORDER = "SELECT min(o_orderdate) FROM orders"
_HISTORY = f"""
  SELECT row_number() OVER (ORDER BY CustomerNo) AS CustomerKey, CustomerNo, CustomerName, City,
         DATE '1990-01-01' AS ValidFrom,
         CASE WHEN Segment = 'BUILDING' THEN DATE '1998-07-01' ELSE DATE '9999-12-31' END AS ValidTo,
         Segment <> 'BUILDING' AS IsCurrent
  FROM ({CUSTOMERS_SQL}) WHERE Segment <> 'MACHINERY'
  UNION ALL
  SELECT (SELECT count(*) FROM customer WHERE c_mktsegment <> 'MACHINERY') + row_number() OVER (ORDER BY CustomerNo),
         CustomerNo, CustomerName, CASE WHEN Segment = 'BUILDING' THEN 'NEW ' || City ELSE City END,
         DATE '1998-07-01', DATE '9999-12-31', true
  FROM ({CUSTOMERS_SQL}) WHERE Segment IN ('BUILDING', 'MACHINERY')"""
_LATE = f"""
  WITH history AS ({_HISTORY}),
  changes AS (
    SELECT CustomerNo, CustomerName, Segment, City, unnest(CASE Segment
             WHEN 'HOUSEHOLD' THEN [('1996-03-01', 'e'), ('1997-05-01', 'e'), ('1998-01-01', 'c'), ('1999-09-09', 'u')]
             WHEN 'BUILDING' THEN [('1995-01-15', 'e'), ('1998-07-01', 'c')]
             WHEN 'FURNITURE' THEN [('1990-01-01', 'e')] WHEN 'AUTOMOBILE' THEN [('1997-01-01', 'c')]
             WHEN 'MACHINERY' THEN [('1997-02-03', 'e')] END) AS c
    FROM ({CUSTOMERS_SQL})),
  events AS (
    SELECT CustomerNo, CustomerName, City, ValidFrom, CustomerKey, 0 AS late FROM history
    UNION ALL
    SELECT CustomerNo, CustomerName, CASE c[2] WHEN 'c' THEN City WHEN 'e' THEN 'EAST ' || City ELSE upper('EAST ' || City) END,
           CAST(c[1] AS DATE), NULL, 1 FROM changes),
  days AS (
    SELECT CustomerNo, ValidFrom, any_value(CustomerName) AS CustomerName, arg_max(City, late) AS City, max(CustomerKey) AS CustomerKey
    FROM events GROUP BY ALL),
  marked AS (
    SELECT *, CASE WHEN lag(City) OVER w = City THEN 0 ELSE 1 END AS fresh FROM days
    WINDOW w AS (PARTITION BY CustomerNo ORDER BY ValidFrom)),
  runs AS (SELECT *, sum(fresh) OVER (PARTITION BY CustomerNo ORDER BY ValidFrom) AS run FROM marked),
  joined AS (
    SELECT CustomerNo, any_value(CustomerName) AS CustomerName, any_value(City) AS City, min(ValidFrom) AS ValidFrom,
           arg_min(CustomerKey, ValidFrom) FILTER (CustomerKey IS NOT NULL) AS CustomerKey
    FROM runs GROUP BY CustomerNo, run),
  closed AS (
    SELECT *, coalesce(lead(ValidFrom) OVER (PARTITION BY CustomerNo ORDER BY ValidFrom), DATE '9999-12-31') AS ValidTo FROM joined)
  SELECT coalesce(CustomerKey, (SELECT max(CustomerKey) FROM history)
                  + row_number() OVER (PARTITION BY CustomerKey IS NULL ORDER BY CustomerNo, ValidFrom)) AS CustomerKey,
         CustomerNo, CustomerName, City, ValidFrom, ValidTo, ValidTo = DATE '9999-12-31' AS IsCurrent
  FROM closed"""
_PLACED = f"SELECT CustomerNo, CustomerName, Segment, nullif(City, 'NATION_3') AS City, CountryRegion FROM ({CUSTOMERS_SQL})"

# The fact table's columns are the ones asked for.
def _sales_sql(known: str, wanted: str) -> str:
    return f"""SELECT * FROM (
           SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS OrderDateKey, CustomerKey, ProductKey, StoreKey,
                  CAST(l_orderkey AS VARCHAR) AS OrderNumber, l_linenumber AS OrderLineItem,
                  CAST(l_quantity AS SMALLINT) AS OrderQuantity,
                  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS UnitPrice,
                  CAST(CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS Discount,
                  CAST(CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS Tax,
                  CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                       AS DECIMAL(18,4)) AS DOUBLE) AS SalesAmount
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS CustomerKey FROM customer) ON c_custkey = o_custkey
           LEFT JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS ProductKey FROM part WHERE {known})
             ON p_partkey = l_partkey
           JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS StoreKey FROM supplier) ON s_suppkey = l_suppkey)
           WHERE {wanted}"""


_PARTIES = f"""
  SELECT CASE Origin WHEN 'shop' THEN 0 ELSE (SELECT count(*) FROM customer) END
           + row_number() OVER (PARTITION BY Origin ORDER BY PartyNo) AS PartyKey,
         Origin, PartyNo, PartyName, City, Since, Versions,
         (PartyNo IN (SELECT c_custkey FROM customer))::BIGINT + (PartyNo IN (SELECT s_suppkey FROM supplier))::BIGINT AS SharedBy
  FROM (SELECT 'shop' AS Origin, CustomerNo AS PartyNo, CustomerName AS PartyName,
               CASE WHEN Segment = 'BUILDING' THEN 'NEW ' || City ELSE City END AS City,
               CASE WHEN Segment = 'BUILDING' THEN DATE '1998-01-01' ELSE DATE '1997-01-01' END AS Since,
               CASE WHEN Segment = 'BUILDING' THEN 2 ELSE 1 END::BIGINT AS Versions FROM ({CUSTOMERS_SQL})
        UNION ALL
        SELECT 'supply', s_suppkey, s_name, n_name, DATE '1997-01-01', 1
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


QUERIES = {
    "surrogate_key_full": (
        surrogate_key_full,
        f"""SELECT row_number() OVER (ORDER BY StockCode) AS StockKey, StockCode, ProductName, ProductCategory,
                   CAST(ListPrice AS DOUBLE) AS ListPrice FROM ({_STAGED})""",
    ),
    "dim_append_identity": (
        dim_append_identity,
        f"""SELECT StockKey, StockCode, ProductName, ProductCategory, CAST(ListPrice AS DOUBLE) AS ListPrice
            FROM ({_KEYED} UNION ALL {_ARRIVED})""",
    ),
    "dim_upsert_rebuild": (
        dim_upsert_rebuild,
        f"""SELECT StockKey, StockCode, ProductName, ProductCategory,
                   CAST(CASE WHEN p_size >= 25 THEN ListPrice + 10 ELSE ListPrice END AS DOUBLE) AS ListPrice
            FROM ({_KEYED} UNION ALL {_ARRIVED})""",
    ),
    "dim_multi_source": (dim_multi_source, _PARTIES),
    "dim_multi_source_conflicts": (
        dim_multi_source_conflicts,
        f"SELECT * FROM ({_PARTIES}) WHERE Versions > 1 OR SharedBy > 1",
    ),
    "dim_date_build": (dim_date_build, _calendar(_FIRST_ORDER, "SELECT max(o_orderdate) FROM orders")),
    "dim_date_extend": (
        dim_date_extend,
        _calendar(_FIRST_ORDER, "SELECT greatest(max(l_shipdate), (SELECT max(o_orderdate) FROM orders)) FROM lineitem"),
    ),
    "dim_time_hour_build": (
        dim_time_hour_build,
        """SELECT CAST(strftime(t, '%Y%m%d%H') AS BIGINT) AS TimeKey, CAST(t AS DATE) AS DateAltKey,
                  CAST(hour(t) AS BIGINT) AS HourOfDay
           FROM (SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)),
                                               (SELECT max(ts) FROM events), INTERVAL 1 HOUR)) AS t)""",
    ),
    "dim_scd2": (dim_scd2, _HISTORY),
    "fact_point_in_time_key": (
        fact_point_in_time_key,
        f"""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS OrderDate, CustomerKey
            FROM orders LEFT JOIN ({_HISTORY}) ON o_custkey = CustomerNo AND CAST(o_orderdate AS DATE) >= ValidFrom
                                              AND CAST(o_orderdate AS DATE) < ValidTo""",
    ),
    "dim_scd2_late": (dim_scd2_late, _LATE),
    "fact_as_of_key": (
        fact_as_of_key,
        f"""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS OrderDate, CustomerKey
            FROM orders LEFT JOIN ({_LATE}) ON o_custkey = CustomerNo AND CAST(o_orderdate AS DATE) >= ValidFrom
                                           AND CAST(o_orderdate AS DATE) < ValidTo""",
    ),
    "dim_snowflake_split": (
        dim_snowflake_split,
        f"""SELECT CustomerNo, CustomerName, Segment, City, CountryRegion,
                   dense_rank() OVER (ORDER BY City NULLS FIRST, CountryRegion NULLS FIRST) AS GeographyKey
            FROM ({_PLACED})""",
    ),
    "dim_time_minute_build": (
        dim_time_minute_build,
        """SELECT CAST(strftime(t, '%Y%m%d%H%M') AS BIGINT) AS TimeKey, CAST(t AS DATE) AS DateAltKey,
                  CAST(hour(t) AS BIGINT) AS HourOfDay, CAST(minute(t) AS BIGINT) AS MinuteOfHour
           FROM (SELECT unnest(generate_series(date_trunc('minute', (SELECT min(ts) FROM events)),
                                               (SELECT max(ts) FROM events), INTERVAL 1 MINUTE)) AS t)""",
    ),
    "fact_sales_build": (fact_sales_build, _sales_sql("true", "true")),
    "fact_sales_rejects": (fact_sales_rejects, _sales_sql("p_size <= 40", "ProductKey IS NULL")),
    "check_unique": (
        check_unique,
        """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
           GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    ),
    "check_referential": (
        check_referential,
        """SELECT l_partkey, count(*) AS row_count FROM lineitem
           WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY l_partkey""",
    ),
    "check_not_null": (
        check_not_null,
        """SELECT 'c_custkey' AS column_name, count(*) FILTER (c_custkey IS NULL) AS null_count FROM customer
           UNION ALL SELECT 'segment', count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer
           UNION ALL SELECT 'balance', count(*) FILTER (NOT c_acctbal >= 0) FROM customer""",
    ),
    "check_length": (
        check_length,
        f"""SELECT 'ProductName' AS column_name, CAST(20 AS BIGINT) AS max_length,
                   count(*) FILTER (length(ProductName) > 20) AS violations FROM ({_STAGED})
            UNION ALL SELECT 'ProductCategory', 5, count(*) FILTER (length(ProductCategory) > 5) FROM ({_STAGED})
            UNION ALL SELECT 'ProductID', 13, count(*) FILTER (length(StockCode) > 13) FROM ({_STAGED})
            UNION ALL SELECT 'ListPrice', 5, count(*) FILTER (round(ListPrice * 1.05, 2) >= 1000) FROM ({_STAGED})""",
    ),
}
