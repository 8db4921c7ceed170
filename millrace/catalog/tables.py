"""Databases and table definitions."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Database; its managed tables live below the location if one is given."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {name}{where}")
    return name


@contextmanager
def using(spark: SparkSession, database: str):
    """USE a database for the length of a block."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def create_table(spark: SparkSession, name: str, columns: str) -> DataFrame:
    """Table with types and nullability; an existing one is an error."""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
    return spark.table(name)


def create_table_if_missing(spark: SparkSession, name: str, columns: str) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
    return spark.table(name)


def create_or_replace_table(spark: SparkSession, name: str, columns: str) -> DataFrame:
    """Parquet tables have no atomic replace: the old table goes first."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return create_table(spark, name, columns)


def register_folder(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Table over existing Parquet files, columns taken from them."""
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


class TableBuilder:
    """Table definition collected column by column."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark = spark
        self._name = name
        self._schema = StructType()

    def column(self, name: str, kind: str, nullable: bool = True) -> TableBuilder:
        field = StructType.fromDDL(f"`{name}` {kind}").fields[0]
        self._schema = self._schema.add(name, field.dataType, nullable)
        return self

    def create(self, path: str | None = None) -> DataFrame:
        return self._spark.catalog.createTable(self._name, path=path, source="parquet", schema=self._schema)

    def create_if_missing(self, path: str | None = None) -> DataFrame:
        exists = self._spark.catalog.tableExists(self._name)
        return self._spark.table(self._name) if exists else self.create(path)

    def create_or_replace(self, path: str | None = None) -> DataFrame:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        return self.create(path)
