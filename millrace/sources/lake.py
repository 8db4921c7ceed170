"""Named locations and named file formats, used by readers, writers and tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.paths import sql_text
from millrace.sources.rowsets import Schema, at_pattern


@dataclass(frozen=True)
class FileFormat:
    """A Spark file format with its options."""

    kind: str
    options: dict[str, str] = field(default_factory=dict)


def delimited_format(field_terminator: str = ",", string_delimiter: str = '"') -> FileFormat:
    options = {"sep": field_terminator, "quote": string_delimiter, "escape": string_delimiter}
    return FileFormat("csv", options)


def parquet_format(compression: str = "snappy") -> FileFormat:
    return FileFormat("parquet", {"compression": compression})


class Lake:
    """Registry of data sources (name to base path) and file formats."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sources: dict[str, str] = {}
        self._formats: dict[str, FileFormat] = {}

    def create_source(self, name: str, location: str) -> None:
        self._add(self._sources, name, location.rstrip("/"))

    def create_format(self, name: str, file_format: FileFormat) -> None:
        self._add(self._formats, name, file_format)

    @staticmethod
    def _add(known: dict, name: str, value) -> None:
        if name in known:
            raise ValueError(f"{name} exists already")
        known[name] = value

    def path(self, location: str, source: str | None = None) -> str:
        """Full path of a location relative to a source; a full path stays as it is."""
        return f"{self._sources[source]}/{location.strip('/')}" if source else location

    def read(
        self,
        location: str,
        source: str | None = None,
        file_format: str = "ParquetFormat",
        schema: Schema | None = None,
        **options: str,
    ) -> DataFrame:
        chosen = self._formats[file_format]
        reader = self.spark.read.format(chosen.kind).options(**{**chosen.options, **options})
        if schema:
            reader = reader.schema(schema)
        reader, path = at_pattern(reader, self.path(location, source))
        return reader.load(path)

    def write(self, df: DataFrame, location: str, source: str | None, file_format: str, **options: str) -> str:
        """Write a frame to a new folder; an existing one is an error."""
        chosen = self._formats[file_format]
        path = self.path(location, source)
        df.write.format(chosen.kind).options(**{**chosen.options, **options}).save(path)
        return path

    def external_table(
        self, name: str, columns: str, location: str, source: str | None, file_format: str, **options: str
    ) -> DataFrame:
        """Catalog table with fixed columns over files."""
        chosen = self._formats[file_format]
        settings = {**chosen.options, **options, "path": self.path(location, source)}
        pairs = ", ".join(f"'{k}' {sql_text(v)}" for k, v in settings.items())
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING {chosen.kind} OPTIONS ({pairs})")
        return self.spark.table(name)

    def table_as_select(self, df: DataFrame, name: str, location: str, source: str | None, file_format: str) -> DataFrame:
        """Store a query result as files below a source and register them as a table.

        The folder must not exist: dropping such a table leaves its files, and
        adding to leftovers would mix two results.
        """
        chosen = self._formats[file_format]
        writer = df.write.format(chosen.kind).options(**chosen.options)
        writer.mode("errorifexists").save(self.path(location, source))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return self.external_table(name, columns, location, source, file_format)
