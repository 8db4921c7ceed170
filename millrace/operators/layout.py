"""Table placement: hash, round-robin and replicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is copied to every executor only below this measured size.
REPLICATE_BYTES = 64 * 1024 * 1024
REPLICATE_ROWS = 1_000_000


def measured_bytes(df: DataFrame, max_rows: int = REPLICATE_ROWS) -> int | None:
    """Approximate size in memory, or None when the frame has more rows than asked."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, T.AtomicType):
            width = width + 16
        else:
            return None
    # Partial sums: one row per task reaches the last one.
    rows, size = df.agg(F.count("*"), F.sum(width.cast("bigint"))).first()
    return None if rows > max_rows else (size or 0)


def replicated(dimension: DataFrame, max_bytes: int = REPLICATE_BYTES) -> DataFrame:
    """Ask for a broadcast if the measured size allows it.

    A larger dimension is returned as it is: its joins then shuffle on the key.
    """
    size = measured_bytes(dimension)
    return F.broadcast(dimension) if size is not None and size <= max_bytes else dimension


def round_robin(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly, whatever their values."""
    spark = df.sparkSession
    return df.repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))


def save_hashed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Write a table hash-distributed (bucketed) on a key.

    Equally bucketed tables join on the key without a shuffle. A bucket is read
    by one task, so for a key that holds a large part of the rows the caller
    chooses ``round_robin`` instead: such joins shuffle, where adaptive skew
    handling can split the key.
    """
    # One shuffle on the key first: one file per bucket instead of one per bucket and task.
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key)
    writer.format("parquet").option("path", path).saveAsTable(table)
