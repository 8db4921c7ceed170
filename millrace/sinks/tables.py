"""Catalog tables: saving, loading, rebuilding and swapping."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.files import Files
from millrace.functions.paths import sql_text
from millrace.operators.keys import append_members
from millrace.operators.quality import require_constraints
from millrace.session import scratch
from millrace.sinks.folders import swap_in, write_beside

_BAD = "_corrupt_record"


class TooManyErrors(ValueError):
    """A bulk load met more bad rows than allowed."""


def _require_external(spark: SparkSession, name: str) -> None:
    """Raise if dropping the table would delete files, or if the name is a view's."""
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{name} is there already, as {kind}: drop it first if its rows may go")


def _written_partitions(spark: SparkSession, parent: str, by: list[str]) -> list[dict[str, str]]:
    """Values of the partition folders below a path, as they are written in the folder names."""
    files = Files(spark, parent)
    found: list[tuple[str, dict[str, str]]] = [("", {})]
    for column in by:
        found = [
            (f"{folder}/{name}".lstrip("/"), values | {column: name.partition("=")[2]})
            for folder, values in found
            for name in files.names(folder)
        ]
    return [values for _, values in found]


def save_external(df: DataFrame, name: str, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Table whose files stay when it is dropped.

    A table of that name is replaced if it is external. A managed one raises, and
    nothing is written: dropping it would delete its rows, and the new ones too if
    it lies at the path.
    """
    spark = df.sparkSession
    _require_external(spark, name)
    # Complete beside the target first: the frame may read the files it replaces.
    swap_in(spark, path, write_beside(df, path, partition_by))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION {sql_text(path)}")
    if partition_by:
        _add_partitions(spark, name, path, partition_by)
    return spark.table(name)


# Partitions named in one statement.
_ADDED_AT_ONCE = 500


def _add_partitions(spark: SparkSession, name: str, path: str, by: list[str]) -> None:
    """Register the partition folders by their names; the files in them are not listed."""
    found = _written_partitions(spark, path, by)
    for i in range(0, len(found), _ADDED_AT_ONCE):
        specs = [
            ", ".join(
                f"`{c}` = NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"`{c}` = {sql_text(unquote(v))}" for c, v in values.items()
            )
            for values in found[i : i + _ADDED_AT_ONCE]
        ]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({s})" for s in specs))


def save_managed(df: DataFrame, name: str) -> DataFrame:
    """Table whose files go when it is dropped."""
    df.write.saveAsTable(name, format="parquet")
    return df.sparkSession.table(name)


def insert_checked(
    df: DataFrame, table: str, not_null: list[str] | None = None, max_lengths: dict[str, int] | None = None
) -> None:
    """Append rows after checking the constraints a Parquet table does not enforce.

    NOT NULL columns of the table's definition are not kept by the catalog, so
    they are named here. Nothing is written when a row breaks a rule.
    """
    require_constraints(df, not_null or [], max_lengths or {}, table)
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def swap(spark: SparkSession, current: str, rebuilt: str, archive: str) -> None:
    """Put a rebuilt table in the place of the current one, which is kept as archive."""
    spark.sql(f"ALTER TABLE {current} RENAME TO {archive}")
    try:
        spark.sql(f"ALTER TABLE {rebuilt} RENAME TO {current}")
    except Exception:
        spark.sql(f"ALTER TABLE {archive} RENAME TO {current}")
        raise


def rebuild_external(spark: SparkSession, name: str, path: str, query: str, **parameters) -> DataFrame:
    """Drop and recreate an external table from a parameterised query.

    The result is complete in a folder of its own before the old table and its
    folder go, so the query may even read the table it rebuilds. A managed table of
    that name raises and keeps its rows.
    """
    _require_external(spark, name)
    rows = spark.sql(query, args=parameters)
    fresh = write_beside(rows, path)
    swap_in(spark, path, fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path=path, source="parquet", schema=rows.schema)


REASONS = "reasons"
UNREADABLE = "does not parse"


def _reasons(not_null: list[str], max_lengths: dict[str, int], parsed: bool):
    """Names of the rules a row breaks; a row that does not parse breaks no other."""
    rules = {f"{c} is NULL": F.col(c).isNull() for c in not_null}
    rules |= {f"{c} is longer than {n}": F.char_length(c) > n for c, n in max_lengths.items()}
    broken = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()])).cast("array<string>")
    return F.when(F.col(_BAD).isNotNull(), F.array(F.lit(UNREADABLE))).otherwise(broken) if parsed else broken


def copy_into(
    spark: SparkSession,
    table: str,
    columns: list[str],
    path: str,
    file_type: str = "PARQUET",
    max_errors: int = 0,
    identity: tuple[str, list[str]] | None = None,
    not_null: list[str] | None = None,
    max_lengths: dict[str, int] | None = None,
    **options: str,
) -> DataFrame:
    """Append files to a table, taking the listed columns by name; returns the rows left out, with REASONS.

    CSV files need the listed columns in file order. A row that does not parse,
    or that breaks a NOT NULL or length rule named here, is bad: up to
    ``max_errors`` bad rows are left out, more raise TooManyErrors and nothing is
    loaded. Table columns that are not listed get NULL. With
    ``identity=(key, business_key)`` a key in the files is not accepted, nor
    judged: the loaded rows are numbered after the keys already in the table.

    Where a row can be bad, each is parsed once and written with its verdict; the
    count, the load and the rows left out all read that copy, so a failed load can
    be repeated and rejects are kept before anything is loaded.
    """
    target = spark.table(table)
    known = {f.name: f for f in target.schema.fields}
    key = identity[0] if identity else None
    parsed = file_type.upper() != "PARQUET"
    if parsed:
        # The refused key is read as text, so whatever it holds it parses.
        fields = [StructField(c, StringType()) if c == key or c not in known else known[c] for c in columns]
        options = {"columnPruning": "false", **options}
        marked = StructType([*fields, StructField(_BAD, StringType())])
        rows = spark.read.schema(marked).options(mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, **options).csv(path)
    else:
        rows = spark.read.parquet(path).select(*columns).withColumn(_BAD, F.lit(None).cast("string"))
    judged = rows.withColumn(REASONS, _reasons(not_null or [], max_lengths or {}, parsed))
    if parsed or not_null or max_lengths:
        judged.write.parquet(copy := scratch(spark, "judged"))
        judged = spark.read.schema(judged.schema).parquet(copy)
        found = judged.where(F.size(REASONS) > 0).count()
        if found > max_errors:
            raise TooManyErrors(f"{found} bad rows in {path}, {max_errors} allowed")
    good = judged.where(F.size(REASONS) == 0)
    present = set(columns) - {key}
    filled = good.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
            if f.name != key
        ]
    )
    if identity:
        filled = append_members(target, filled, identity[1], key)
    filled.select(*target.columns).write.insertInto(table)
    return judged.where(F.size(REASONS) > 0)
