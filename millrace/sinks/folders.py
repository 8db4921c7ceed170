"""Parquet folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.files import Files


def gathered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Bring the rows of a partition folder together before a partitioned write.

    Without it every task writes a file into every folder. Rebalancing lets
    adaptive execution split a crowded folder over several tasks.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def write_beside(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write Parquet to a new hidden folder next to a path; returns its name."""
    parent, name = _split(path)
    fresh = f"_{name}.new-{uuid.uuid4().hex}"
    gathered(df, partition_by).write.partitionBy(*(partition_by or [])).parquet(f"{parent}/{fresh}")
    return fresh


def swap_in(spark: SparkSession, path: str, fresh: str) -> None:
    """Put a folder written beside a path in its place; the old one goes last."""
    parent, name = _split(path)
    files = Files(spark, parent)
    old = f"_{name}.old-{uuid.uuid4().hex}"
    if files.exists(name):
        files.move(name, old)
    try:
        files.move(fresh, name)
    except Exception:
        if files.exists(old):
            files.move(old, name)
        raise
    files.delete(old)


def replace_folder(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet folder by a frame, even one computed from that folder.

    ``mode("overwrite")`` empties the target before the plan reads it. Here the
    new files are written beside the target and swapped in by renaming.
    """
    swap_in(df.sparkSession, path, write_beside(df, path, partition_by))


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write partition folders, replacing only those the frame has rows for."""
    writer = gathered(df, partition_by).write.partitionBy(*partition_by).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
