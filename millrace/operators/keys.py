"""Running row positions and surrogate keys without a single-task window.

A ``row_number()`` over an unpartitioned window moves the whole table into one
task. Here the rows are range-partitioned on the order instead, every task
numbers its own range, and the sizes of the earlier ranges are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch

_TIE, _ID, _RANGE, _BEFORE = "_tie", "_row_id", "_range", "_rows_before"
# monotonically_increasing_id() is (partition number << 33) + row number.
_ROW_BITS = 33


# Plan nodes that read the same rows in the same order whenever a task is repeated.
_STEADY = ("FileSourceScanExec", "BatchScanExec", "LocalTableScanExec", "RangeExec")


def _steady(node) -> bool:
    """Whether a physical plan reads such sources only and shuffles nothing."""
    kind, children = node.getClass().getSimpleName(), node.children()
    if children.isEmpty():
        return kind in _STEADY
    shuffles = any(word in kind for word in ("Exchange", "Limit", "TakeOrdered"))
    return not shuffles and all(_steady(children.apply(i)) for i in range(children.size()))


def stored(df: DataFrame) -> DataFrame:
    """The frame itself if its rows come straight from files, else a written copy.

    After a shuffle a repeated task may see its rows in another order, so a row's
    place could change. The copy also spares computing the input twice: once to
    sample range bounds and once to shuffle.
    """
    if _steady(df._jdf.queryExecution().executedPlan()):
        return df
    path = scratch(df.sparkSession, "input")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_positions(df: DataFrame, order_by: list[Column], name: str) -> DataFrame:
    """Append the 1-based position of each row in the total order.

    Rows equal in ``order_by`` are told apart by their place in the input, which
    also lets a heavily repeated value spread over many ranges. The numbered
    ranges are written once: range bounds come from a sample, so recomputing
    them could move rows between ranges.
    """
    spark = df.sparkSession
    order = [*order_by, F.col(_TIE).asc()]
    path = scratch(spark, "positions")
    ranged = (
        stored(df)
        .withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(_TIE)
        .withColumn(_ID, F.monotonically_increasing_id())
        .withColumn(_RANGE, F.shiftright(_ID, _ROW_BITS))
    )
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    # One row per range, so at most as many rows as there were shuffle tasks:
    # the running total and the broadcast below stay small at any table size.
    ranges = rows.groupBy(_RANGE).agg(F.count("*").alias("n"))
    running = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select(_RANGE, F.coalesce(F.sum("n").over(running), F.lit(0)).alias(_BEFORE))
    within = F.col(_ID) - F.shiftleft(F.col(_RANGE), _ROW_BITS)
    return rows.join(F.broadcast(before), _RANGE).select(
        *df.columns, (F.col(_BEFORE) + within + 1).cast("bigint").alias(name)
    )


def assign_keys(df: DataFrame, business_key: list[str], key: str, start: int = 1) -> DataFrame:
    """Surrogate keys start, start+1, ... in business-key order, as first column."""
    numbered = ordered_positions(df, [F.col(c).asc() for c in business_key], key)
    return numbered.select((F.col(key) + (start - 1)).alias(key), *df.columns)


def next_key(dimension: DataFrame, key: str) -> int:
    """First unused surrogate key."""
    return (dimension.agg(F.max(key)).first()[0] or 0) + 1


def append_members(dimension: DataFrame, members: DataFrame, business_key: list[str], key: str) -> DataFrame:
    """Only the new members, keyed after the largest key in use.

    ``members`` must hold new members only; see ``new_members``.
    """
    attributes = [c for c in dimension.columns if c != key]
    keyed = assign_keys(members.select(*attributes), business_key, key, next_key(dimension, key))
    return keyed.select(*dimension.columns)


def new_members(staged: DataFrame, dimension: DataFrame, business_key: list[str]) -> DataFrame:
    """Staged rows whose business key the dimension does not hold yet.

    The dimension's keys are reduced to distinct ones first, so history rows of
    one member cannot pile up in the join.
    """
    return staged.join(dimension.select(*business_key).distinct(), business_key, "left_anti")
