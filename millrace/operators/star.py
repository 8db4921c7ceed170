"""Star and snowflake aggregation.

A measure is summed per foreign key before a dimension is joined. The join and
its shuffle then carry one row per key in use, and a key held by very many facts
is already one row per task when it reaches the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.facts import Lookup


def sum_by(facts: DataFrame, keys: Sequence[str], measure: str, total: str | None = None) -> DataFrame:
    """SUM of a measure per key tuple."""
    return facts.groupBy(*keys).agg(F.sum(measure).alias(total or measure))


def roll_up(
    sums: DataFrame, lookup: Lookup, attributes: list[str], measure: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Replace the foreign key of summed facts by attributes of its dimension, and sum again.

    ``sums`` has one row per ``keep`` and foreign key, from ``sum_by`` or from the
    roll-up before.
    """
    dimension = lookup.dimension.select(F.col(lookup.business_key).alias(lookup.column), *attributes)
    return sum_by(sums.join(dimension, lookup.column), [*keep, *attributes], measure)


def distinct_per(facts: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """Exact distinct count; duplicates are dropped map-side before the shuffle."""
    return facts.groupBy(group).agg(F.count_distinct(column).alias(name))


# 2% at 97% probability: 2.17 standard deviations of the estimate.
APPROX_ERROR = 0.02 / 2.17


def approx_distinct_per(facts: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """HyperLogLog++ distinct count, within 2% with 97% probability."""
    return facts.groupBy(group).agg(F.approx_count_distinct(column, APPROX_ERROR).alias(name))


def rate(part: Column, whole: Column) -> Column:
    """Relative deviation of one figure from another."""
    return F.abs(part - whole) / whole


# ---- distinct counts that roll up -------------------------------------------

# Sketches of 2 ** SKETCH_BITS registers: a standard error of 0.83 / sqrt(2 ** SKETCH_BITS),
# so 2% is more than nine standard errors. At most 2 ** SKETCH_BITS bytes each.
SKETCH_BITS = 13


def distinct_sketches(facts: DataFrame, keys: Sequence[str], column: str, sketch: str = "sketch") -> DataFrame:
    """A sketch of a column's values per key: kept as a column, it can be merged to any coarser key.

    Sketches are built map-side, so a shuffle carries one per key and task.
    """
    return facts.groupBy(*keys).agg(F.hll_sketch_agg(column, SKETCH_BITS).alias(sketch))


def merged_sketches(sketches: DataFrame, keys: Sequence[str | Column], name: str, sketch: str = "sketch") -> DataFrame:
    """Estimated distinct values per coarser key, from sketches alone."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name))


BUCKET, BITS = "bucket", "bits"


def distinct_bitmaps(facts: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Bitmaps of an integer column's values per key and BUCKET of 32,768 numbers; NULLs are left out.

    Exact, and merged by OR to any coarser key. A bucket in use takes 4 KB, so it
    suits numbers that lie close together, as surrogate keys do.
    """
    numbers = facts.where(F.col(column).isNotNull())
    return numbers.groupBy(*keys, F.bitmap_bucket_number(column).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias(BITS)
    )


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Exact distinct values per coarser key, from bitmaps alone."""
    merged = bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    names = [c for c in merged.columns if c not in (BUCKET, BITS)]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count(BITS)).alias(name))


# ---- subtotals --------------------------------------------------------------

def subtotals(sums: DataFrame, hierarchy: list[str], measure: str, level: str = "Level") -> DataFrame:
    """Totals of every level of a hierarchy, outermost first, over rows that are summed already.

    ``level`` says how many of the columns a row is a total of: 0 is the grand
    total; the columns below it are NULL, which a NULL of the data does not resemble.
    """
    # grouping_id has a bit for each column that is not grouped by, the innermost lowest.
    depth = F.lit(len(hierarchy)) - F.bit_count(F.grouping_id())
    totals = sums.rollup(*hierarchy).agg(depth.cast("bigint").alias(level), F.sum(measure).alias(measure))
    return totals.select(level, *hierarchy, measure)
