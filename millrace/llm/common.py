"""What the operators of this subpackage share: staged tables and word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch

# Words are maximal runs of anything but these six ASCII characters.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once to the shared scratch folder and read from there.

    Cuts the lineage: a lost executor costs the tasks it ran, not the whole job.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or the name with underscores after it, such that no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lowered: bytes.lower and bytes.split know ASCII only."""
    return text.encode("utf-8").lower().split()


def bucket_of_id(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold a document belongs to (null id: fold of '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
