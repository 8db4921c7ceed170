"""Rowsets straight from files: delimited text, JSON documents, Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.types import StructType

Schema = str | StructType

# Separator that does not occur in JSON text: a file without it is one document.
DOCUMENT_END = "\x0b"


def at_pattern(reader: DataFrameReader, path: str) -> tuple[DataFrameReader, str]:
    """Give path endings their meaning: ``/**`` all files below, ``/*`` all files in the folder.

    A Spark glob ``folder/*`` would also enter sub-folders and ``**`` would not
    recurse, so both become a folder path.
    """
    if path.endswith("/**"):
        return reader.option("recursiveFileLookup", True), path[:-3]
    if path.endswith("/*"):
        return reader, path[:-2]
    return reader, path


def delimited(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    first_row: int = 1,
    header_row: bool = False,
    field_terminator: str = ",",
    row_terminator: str | None = None,
    field_quote: str = '"',
    escape: str | None = None,
    encoding: str = "UTF-8",
    **options: str,
) -> DataFrame:
    """Delimited text files.

    ``header_row`` takes names from the first line of each file; ``first_row=2``
    skips that line. Types come from the schema, else they are inferred, which
    reads the files once more. Unnamed columns are called C1, C2, ...
    """
    if first_row not in (1, 2):
        raise ValueError("first_row must be 1 or 2")
    reader = spark.read.options(
        header=header_row or first_row == 2,
        sep=field_terminator,
        quote=field_quote,
        escape=escape or field_quote,
        encoding=encoding,
        **options,
    )
    if row_terminator:
        reader = reader.option("lineSep", row_terminator)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    reader, folder = at_pattern(reader, path)
    df = reader.csv(folder)
    if schema is None and not header_row:
        df = df.toDF(*[f"C{i}" for i in range(1, len(df.columns) + 1)])
    return df


def untyped(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with a header, every column a string; no inference pass."""
    return spark.read.option("header", True).csv(path)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents as text, one per row, in column ``doc``."""
    reader, folder = at_pattern(spark.read.option("lineSep", DOCUMENT_END), path)
    return reader.text(folder).withColumnRenamed("value", "doc")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with the schema they carry."""
    reader, folder = at_pattern(spark.read, path)
    return reader.parquet(folder)


def partition_folder(spark: SparkSession, root: str, leaf: str, keep_columns: bool = True) -> DataFrame:
    """One folder of a partitioned tree, with or without its partition columns."""
    reader = spark.read.option("basePath", root) if keep_columns else spark.read
    return reader.parquet(f"{root}/{leaf}")
