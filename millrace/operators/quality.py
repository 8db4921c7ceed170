"""Checks a load job runs because the tables themselves enforce nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A check that must hold does not."""


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys occurring more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).where("row_count > 1")


def require_unique(df: DataFrame, key: list[str], what: str) -> None:
    """Raise if a key without NULLs repeats."""
    present = df.dropna(subset=key)
    found = duplicate_keys(present, key).limit(5).collect()
    if found:
        raise QualityError(f"{what}: repeated keys, e.g. {[tuple(r)[:-1] for r in found]}")


def require_business_key(df: DataFrame, key: str, what: str) -> None:
    """Raise unless a column identifies its rows: never NULL, never repeated."""
    if not df.where(F.col(key).isNull()).isEmpty():
        raise QualityError(f"{what}: {key} is NULL")
    require_unique(df, [key], what)


def orphan_keys(facts: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a dimension row, with their number of facts.

    Facts are counted per value before the join, so a value held by very many
    facts is one row in it. A NULL value is an orphan.
    """
    used = facts.groupBy(column).agg(F.count("*").alias("row_count"))
    keys = dimension.select(F.col(key).alias(column)).distinct()
    return used.join(keys, column, "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: name and number of NULLs, in a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    return counted.select(F.inline(F.array(*pairs)))


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """One row per text column: name, limit and number of longer values."""
    counted = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(n).cast("bigint").alias("max_length"),
            F.col(c).alias("violations"),
        )
        for c, n in limits.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def require_constraints(df: DataFrame, not_null: list[str], max_lengths: dict[str, int], what: str) -> None:
    """Raise if a column that must have a value has none, or a text is too long; one pass."""
    broken = {f"{c} is NULL": F.col(c).isNull() for c in not_null}
    broken |= {f"{c} is longer than {n}": F.length(c) > n for c, n in max_lengths.items()}
    if not broken:
        return
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in broken.items()]).first()
    found = {name: counts[name] for name in broken if counts[name]}
    if found:
        raise QualityError(f"{what}: {found}")


def fits_decimal(column: str, precision: int, scale: int):
    """False where a value cannot be held by DECIMAL(precision, scale)."""
    value = F.col(column)
    return value.isNull() | value.try_cast(f"decimal({precision},{scale})").isNotNull()
