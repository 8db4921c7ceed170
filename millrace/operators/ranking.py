"""ROW_NUMBER, RANK, DENSE_RANK and NTILE that survive one huge partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranges import RANGE, ROW, edges, stored_ranges, with_carried


def _tile(row_number: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a row number: the first ``rows % tiles`` tiles hold one row more."""
    size = F.floor(rows / tiles)
    larger = rows % tiles
    in_larger = larger * (size + 1)
    # size is 0 when a group has fewer rows than tiles; all rows are then in the
    # first branch, but both branches must stay computable.
    return F.when(
        row_number <= in_larger, F.floor((row_number - 1) / (size + 1)) + 1
    ).otherwise(larger + F.floor((row_number - 1 - in_larger) / F.greatest(size, F.lit(1))) + 1)


def _native(df, group, value, descending, tie_break, tiles):
    by_value = F.col(value).desc() if descending else F.col(value).asc()
    ranked = Window.partitionBy(*group).orderBy(by_value)
    numbered = Window.partitionBy(*group).orderBy(by_value, *tie_break)
    return df.select(
        *df.columns,
        F.row_number().over(numbered).cast("bigint").alias("Position"),
        F.rank().over(ranked).cast("bigint").alias("Place"),
        F.dense_rank().over(ranked).cast("bigint").alias("Step"),
        F.ntile(tiles).over(numbered).cast("bigint").alias("Tile"),
    )


def _carried(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """For the groups that reach into other ranges: what the earlier ranges hold of them.

    A run is the rows of a group with one value. ``_rows`` and ``_runs`` count what
    was before; ``_place`` is the place of the run that goes on from the range
    before, NULL if none does; ``_total`` is the size of the group.
    """
    runs = rows.groupBy(RANGE, *group, value).agg(
        F.count("*").alias("n"), F.min(ROW).alias("at"), F.max(ROW).alias("to")
    )
    boxed = F.struct(value)
    parts = runs.groupBy(RANGE, *group).agg(
        F.sum("n").alias("rows"), F.count("*").alias("runs"), F.min_by(boxed, "at").alias("first"),
        F.max_by(boxed, "at").alias("last"), F.max_by("n", "at").alias("last_rows"),
        F.min("at").alias("begin"), F.max("to").alias("end"),
    )
    parts = edges(parts, "begin", "end")
    along = Window.partitionBy(*group).orderBy(RANGE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_rows", F.coalesce(F.sum("rows").over(before), F.lit(0))).withColumn(
        "goes_on", F.coalesce(F.lag("last").over(along).eqNullSafe(F.col("first")), F.lit(False)) & F.lag(F.lit(1)).over(along).isNotNull()
    )
    # Where the last run of a range began, if it began in this range.
    began = F.when((F.col("runs") > 1) | ~F.col("goes_on"), F.col("_rows") + F.col("rows") - F.col("last_rows") + 1)
    parts = parts.withColumn("began", began)
    return parts.select(
        RANGE, *group, "_rows",
        (F.coalesce(F.sum("runs").over(before), F.lit(0)) - F.sum(F.col("goes_on").cast("bigint")).over(so_far)).alias("_runs"),
        F.when(F.col("goes_on"), F.last("began", ignorenulls=True).over(before)).alias("_place"),
        F.sum("rows").over(Window.partitionBy(*group)).alias("_total"),
    )


def _distributed(df, group, value, descending, tie_break, tiles):
    """All ranks from one total order: within each range by windows, then with what earlier ranges hold added."""
    directed = F.col(value).desc() if descending else F.col(value).asc()
    rows = stored_ranges(df, [*[F.col(c).asc() for c in group], directed, *[F.col(c).asc() for c in tie_break]])
    of_group = Window.partitionBy(RANGE, *group)
    ranked = of_group.orderBy(directed)
    local = rows.select(
        "*",
        F.row_number().over(of_group.orderBy(directed, ROW)).alias("_number"),
        F.rank().over(ranked).alias("_rank"),
        F.dense_rank().over(ranked).alias("_step"),
        F.count("*").over(of_group).alias("_here"),
    )
    joined = with_carried(local, _carried(rows, group, value), group, ["_rows", "_runs", "_place", "_total"])
    rows_before, runs_before = (F.coalesce(c, F.lit(0)) for c in ("_rows", "_runs"))
    row_number = rows_before + F.col("_number")
    in_first_run = F.when(F.col("_step") == 1, F.col("_place"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        row_number.cast("bigint").alias("Position"),
        F.coalesce(in_first_run, rows_before + F.col("_rank")).cast("bigint").alias("Place"),
        (runs_before + F.col("_step")).cast("bigint").alias("Step"),
        _tile(row_number, F.coalesce("_total", "_here"), tiles).cast("bigint").alias("Tile"),
    )


def rank_within(
    df: DataFrame,
    group: list[str],
    value: str,
    tie_break: list[str],
    descending: bool = True,
    tiles: int = 4,
    windows: bool = False,
) -> DataFrame:
    """Append Position, Place, Step and Tile per group: ROW_NUMBER, RANK, DENSE_RANK and NTILE.

    Place and Step see ties in ``value``; Position and Tile use
    ``tie_break`` so that they are repeatable. The numbers come from one pass over
    ranges of the total order, whatever the group sizes; with ``windows`` they come
    from windows over whole groups, which the caller knows to fit a task.
    """
    if not group:
        raise ValueError("no group: use keys.ordered_positions to number a whole table")
    return (_native if windows else _distributed)(df, group, value, descending, tie_break, tiles)
