"""Work along one total order, range by range, whatever the sizes of groups.

A window partitioned by a group moves the whole group into one task. Here rows
are range-partitioned on group and order, written once as a table bucketed by
range, and read back: windows over (range, group) then need no further shuffle,
and a task never holds more than its range. What one range has to know of those
before it concerns its first group only, so it fits a table with at most two rows
per range, which is computed with ordinary windows and broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch, temporary

RANGE, ROW = "_range", "_row"
_TIE = "_tie"
# monotonically_increasing_id() is (partition number << 33) + row number.
_ROW_BITS = 33


def stored_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The frame in ranges of the total order, with RANGE and ROW; ROW rises along the order.

    Rows equal in the order are told apart by their place in the input, so a
    heavily repeated value spreads over several ranges. Everything is written in one
    go, so later readers see one and the same numbering.
    """
    spark = df.sparkSession
    whole = [*order, F.col(_TIE).asc()]
    numbered = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*whole)
        .sortWithinPartitions(*whole)
        .drop(_TIE)
        .withColumn(ROW, F.monotonically_increasing_id())
        .withColumn(RANGE, F.shiftright(ROW, _ROW_BITS))
    )
    name = temporary(spark, "TABLE", f"{spark.catalog.currentDatabase()}.ranges_{uuid.uuid4().hex}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = numbered.write.bucketBy(buckets, RANGE).option("path", scratch(spark, "ranges"))
    writer.saveAsTable(name, format="parquet")
    return spark.table(name)


def same(left: str, right: str, columns: list[str]) -> Column:
    """Equality of columns of two aliased frames; NULL equals NULL."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def edges(summaries: DataFrame, begin: str, end: str) -> DataFrame:
    """Of summaries per RANGE and group, those of the first and the last group of each range.

    Only these groups reach into other ranges. ``begin`` and ``end`` are the least
    and the greatest ROW of the group in the range. The summaries are still
    distributed by range, so this shuffles nothing; two rows per range are left.
    """
    of_range = Window.partitionBy(RANGE)
    marked = summaries.withColumns({"_least": F.min(begin).over(of_range), "_greatest": F.max(end).over(of_range)})
    return marked.where((F.col(begin) == F.col("_least")) | (F.col(end) == F.col("_greatest"))).drop("_least", "_greatest")


def with_carried(rows: DataFrame, carried: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Rows with what their group brings along from earlier ranges; NULL where nothing is carried.

    ``carried`` has at most two rows per range, whatever the size of the table.
    """
    joined = rows.alias("r").join(F.broadcast(carried).alias("c"), same("r", "c", [RANGE, *group]), "left")
    return joined.select("r.*", *[F.col(f"c.{c}").alias(c) for c in columns])
