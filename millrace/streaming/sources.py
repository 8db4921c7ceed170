"""File streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def json_folder(
    spark: SparkSession, path: str, schema: str | StructType, max_files: int | None = None
) -> DataFrame:
    """JSON files as they arrive in a folder, at most ``max_files`` per batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
