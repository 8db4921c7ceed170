"""Queries: versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.inputs import new_database, products, table
from millrace.session import scratch
from millrace.versioned.table import VersionedTable


def _items(spark, folder, only="true"):
    rows = products(spark, folder).join(
        table(spark, folder, "part").select(F.col("p_partkey").alias("ProductID"), F.col("p_size").alias("Size")), "ProductID"
    )
    return rows.select("ProductID", "Category", F.col("ListPrice").cast("float").alias("Price"), "Size").where(only)


def _created(spark, folder, only="true"):
    return VersionedTable.create(_items(spark, folder, only), scratch(spark, "versioned"))


def _priced(df):
    return df.withColumn("Price", F.col("Price").cast("double"))


def versioned_create(spark, folder):
    return _priced(_created(spark, folder).read())


def versioned_overwrite(spark, folder):
    versioned = _created(spark, folder, "Size <= 25")
    versioned.overwrite(_items(spark, folder, "Size > 25"))
    return _priced(versioned.read())


def _appended(spark, folder):
    """Version 0 holds small items, 1 adds large ones, 2 discounts one category."""
    versioned = _created(spark, folder, "Size <= 25")
    versioned.append(_items(spark, folder, "Size > 25"))
    versioned.update("Category = 'PROMO'", {"Price": "Price * 0.9"})
    return versioned


def versioned_append(spark, folder):
    versioned = _created(spark, folder, "Size <= 25")
    versioned.append(_items(spark, folder, "Size > 25"))
    return _priced(versioned.read())


def versioned_read_latest(spark, folder):
    return _priced(_appended(spark, folder).read())


def versioned_as_of_version(spark, folder):
    return _priced(_appended(spark, folder).read(version=0))


def versioned_as_of_timestamp(spark, folder):
    """A moment just before the newest commit shows the version before it."""
    versioned = _appended(spark, folder)
    newest = versioned.latest().timestamp_ms
    moment = spark.sql(f"SELECT CAST(timestamp_millis({newest - 1}) AS TIMESTAMP) AS t")
    text = moment.select(F.date_format(F.to_utc_timestamp("t", F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    return _priced(versioned.read(timestamp=text))


def versioned_update(spark, folder):
    """A NULL condition (size unknown) leaves the row alone."""
    items = _items(spark, folder).withColumn("Size", F.nullif("Size", F.lit(7)))
    versioned = VersionedTable.create(items, scratch(spark, "versioned"))
    versioned.update("Category = 'SMALL' AND Size < 30", {"Price": "Price * 0.9", "Category": "concat(Category, '-SALE')"})
    return _priced(versioned.read())


def versioned_delete(spark, folder):
    versioned = VersionedTable.create(
        _items(spark, folder).withColumn("Size", F.nullif("Size", F.lit(7))), scratch(spark, "versioned")
    )
    versioned.delete("Size < 20")
    return _priced(versioned.read())


def versioned_merge(spark, folder):
    """Known items get a new category and price (NULL included), the largest go, unknown ones come."""
    versioned = _created(spark, folder, "Size <= 35")
    change = _items(spark, folder, "Size >= 20").select(
        "ProductID",
        F.concat(F.lit("NEW-"), "Category").alias("Category"),
        F.when(F.col("Size") != 22, F.col("Price") + 1).cast("float").alias("Price"),
        "Size",
    )
    versioned.merge(change, ["ProductID"], delete_when="t.Size >= 30")
    return _priced(versioned.read())


def versioned_sql_name(spark, folder):
    """A view registered before the changes shows them: rows written again, removed and added."""
    versioned = _created(spark, folder, "Size <= 25")
    name = f"{new_database(spark)}.items"
    versioned.register(name)
    versioned.update("Category = 'PROMO'", {"Price": "Price * 0.9"})
    versioned.delete("Size < 5")
    versioned.append(_items(spark, folder, "Size > 25"))
    return spark.sql(f"SELECT ProductID, Category, CAST(Price AS DOUBLE) AS Price, Size FROM {name}")


def versioned_history(spark, folder):
    versioned = _appended(spark, folder)
    versioned.delete("Size = 50")
    versioned.overwrite(_items(spark, folder))
    totals = versioned.history().select("version", "operation")
    counts = [
        versioned.read(version=v).agg(F.lit(v).cast("bigint").alias("version"), F.count("*").alias("row_count"))
        for v in range(5)
    ]
    rows = counts[0]
    for other in counts[1:]:
        rows = rows.unionByName(other)
    return totals.join(rows, "version")


_ITEMS = """
  SELECT p_partkey AS ProductID, p_type AS Category, CAST(p_retailprice AS FLOAT) AS Price, p_size AS Size FROM part"""


def _as_double(inner: str) -> str:
    return f"SELECT ProductID, Category, CAST(Price AS DOUBLE) AS Price, Size FROM ({inner})"


_CUT = "CAST(CAST(Price AS DOUBLE) * 0.9 AS FLOAT)"
_UNKNOWN = f"SELECT ProductID, Category, Price, nullif(Size, 7) AS Size FROM ({_ITEMS})"

QUERIES = {
    "versioned_create": (versioned_create, _as_double(_ITEMS)),
    "versioned_overwrite": (versioned_overwrite, _as_double(_ITEMS + " WHERE p_size > 25")),
    "versioned_append": (versioned_append, _as_double(_ITEMS)),
    "versioned_read_latest": (
        versioned_read_latest,
        _as_double(
            f"SELECT ProductID, Category, CASE WHEN Category = 'PROMO' THEN {_CUT} ELSE Price END AS Price, Size FROM ({_ITEMS})"
        ),
    ),
    "versioned_as_of_version": (versioned_as_of_version, _as_double(_ITEMS + " WHERE p_size <= 25")),
    "versioned_as_of_timestamp": (versioned_as_of_timestamp, _as_double(_ITEMS)),
    "versioned_update": (
        versioned_update,
        _as_double(
            f"""SELECT ProductID, CASE WHEN Category = 'SMALL' AND Size < 30 THEN 'SMALL-SALE' ELSE Category END AS Category,
                       CASE WHEN Category = 'SMALL' AND Size < 30 THEN {_CUT} ELSE Price END AS Price, Size
                FROM ({_UNKNOWN})"""
        ),
    ),
    "versioned_delete": (versioned_delete, _as_double(f"SELECT * FROM ({_UNKNOWN}) WHERE Size IS NULL OR Size >= 20")),
    "versioned_merge": (
        versioned_merge,
        _as_double(
            f"""SELECT ProductID, CASE WHEN Size >= 20 THEN 'NEW-' || Category ELSE Category END AS Category,
                       CASE WHEN Size = 22 THEN NULL WHEN Size >= 20 THEN CAST(Price + 1 AS FLOAT) ELSE Price END AS Price,
                       Size
                FROM ({_ITEMS}) WHERE Size NOT BETWEEN 30 AND 35"""
        ),
    ),
    "versioned_sql_name": (
        versioned_sql_name,
        _as_double(
            f"""SELECT ProductID, Category, CASE WHEN Category = 'PROMO' AND Size <= 25 THEN {_CUT} ELSE Price END AS Price,
                       Size
                FROM ({_ITEMS}) WHERE Size >= 5"""
        ),
    ),
    "versioned_history": (
        versioned_history,
        """SELECT CAST(version AS BIGINT) AS version, operation, count(*) AS row_count
           FROM part JOIN (VALUES (0, 'create', 1, 25), (1, 'append', 1, 50), (2, 'update', 1, 50),
                                  (3, 'delete', 1, 49), (4, 'overwrite', 1, 50)) v(version, operation, low, high)
             ON p_size BETWEEN low AND high
           GROUP BY version, operation""",
    ),
}
