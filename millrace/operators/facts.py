"""Fact tables: measures with the keys of their dimensions."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.ranges import RANGE, ROW, edges, stored_ranges, with_carried


@dataclass(frozen=True)
class Lookup:
    """How one business-key column of the source becomes a surrogate key."""

    column: str
    dimension: DataFrame
    business_key: str
    key: str


def expect_skew_handling(spark: SparkSession) -> None:
    """Warn a session that would leave a crowded key of a join to one task."""
    for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(name, "true").lower() != "true":
            warnings.warn(f"{name} is off: a crowded key is joined by one task", stacklevel=3)


def replace_keys(source: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Swap every business key for the dimension's key; NULL where none matches.

    Left joins keep unmatched rows, so a check can report them. Each dimension
    has one row per business key: a business key held by very many facts is
    split by adaptive skew handling, and a small dimension is broadcast when
    Spark's own size estimate is below its threshold.
    """
    expect_skew_handling(source.sparkSession)
    for lookup in lookups:
        keys = lookup.dimension.select(
            F.col(lookup.business_key).alias(lookup.column), F.col(lookup.key)
        )
        source = source.join(keys, lookup.column, "left").drop(lookup.column)
    return source


def matched(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts whose every key was found."""
    return facts.dropna(subset=keys)


def unmatched(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts with a key that was not found: together with ``matched`` all of them."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return facts.where(missing)


def point_in_time(facts: DataFrame, day: Column, lookup: Lookup) -> DataFrame:
    """Key of the dimension row that was valid on the fact's day.

    An equi-join on the business key with the validity range as residual
    condition: a fact is compared with all history rows of its member. For members
    with long histories use ``as_of``.
    """
    expect_skew_handling(facts.sparkSession)
    history = lookup.dimension.select(
        F.col(lookup.business_key).alias("_member"), lookup.key, "ValidFrom", "ValidTo"
    )
    dated = facts.withColumn("_day", day)
    valid = (
        (F.col(lookup.column) == F.col("_member"))
        & (F.col("_day") >= F.col("ValidFrom"))
        & (F.col("_day") < F.col("ValidTo"))
    )
    return dated.join(history, valid, "left").drop("_day", "_member", "ValidFrom", "ValidTo")


_MEMBER, _AT, _KIND, _VALID = "_member", "_at", "_kind", "_valid"


def as_of(facts: DataFrame, day: Column, lookup: Lookup) -> DataFrame:
    """Key of the dimension row that was valid on the fact's day, by one pass over facts and history in order.

    Facts and history rows are put in order of member and day, and the last history
    row goes along to the facts that follow: each row is looked at once, however
    long a member's history, and a member of any size spreads over tasks. Facts
    keep all columns and get the key, NULL where no row of their member was valid,
    their day or their member is NULL. History rows of a member must not overlap.
    """
    history = lookup.dimension.where("ValidFrom IS NOT NULL").select(
        F.col(lookup.business_key).alias(_MEMBER),
        F.col("ValidFrom").alias(_AT),
        F.lit(0).alias(_KIND),
        F.struct(F.col(lookup.key).alias("key"), F.coalesce("ValidTo", F.lit("9999-12-31").cast("date")).alias("until")).alias(_VALID),
    )
    dated = facts.select(
        F.struct(*facts.columns).alias("_fact"), F.col(lookup.column).alias(_MEMBER), day.alias(_AT), F.lit(1).alias(_KIND)
    )
    # On one day history comes first.
    rows = stored_ranges(
        dated.unionByName(history, allowMissingColumns=True), [F.col(_MEMBER).asc(), F.col(_AT).asc(), F.col(_KIND).asc()]
    )
    along = Window.partitionBy(RANGE, _MEMBER).orderBy(ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_last", F.last(_VALID, ignorenulls=True).over(along))
    # Of each member that reaches over ranges, the last history row of the ranges before.
    known = F.when(F.col(_VALID).isNotNull(), F.col(ROW))
    latest = rows.groupBy(RANGE, _MEMBER).agg(
        F.max_by(_VALID, known).alias("newest"), F.min(ROW).alias("begin"), F.max(ROW).alias("end")
    )
    latest = edges(latest, "begin", "end")
    before = Window.partitionBy(_MEMBER).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(RANGE, _MEMBER, F.last("newest", ignorenulls=True).over(before).alias("_earlier"))
    joined = with_carried(local, carried, [_MEMBER], ["_earlier"]).where(F.col(_KIND) == 1)
    valid = F.coalesce("_last", "_earlier")
    return joined.select("_fact.*", F.when(F.col(_AT) < valid["until"], valid["key"]).alias(lookup.key))
