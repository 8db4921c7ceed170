"""Line dedup by site-relative frequency.

A line of a page is boilerplate if it stands on more than ``ratio`` of the other
pages of its host: a page is no witness against its own lines, so the rule holds
for hosts of any size, and a host of one page has no boilerplate. Each page counts
a line once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, staged

RATIO = 0.1


def boilerplate(pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO) -> DataFrame:
    """(line_host, bad): for each host the 64-bit hashes of its boilerplate lines.

    Shares of a host's lines add up to the lines of a mean page, so a host has
    at most about (mean lines / ratio) such lines, however many pages it has; the
    list stays small. Lines are counted by (host, hash) with partial sums before
    the shuffle, so a large host is no hot group. Null hosts are one host.
    """
    base = pages.select(F.coalesce(host.cast("string"), F.lit("")).alias("line_host"), lines.alias("lines"))
    totals = base.groupBy("line_host").agg(F.count("*").alias("pages"))
    # Blank lines part paragraphs; they are never boilerplate.
    once = F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    counts = base.select("line_host", F.explode(once).alias("line")).groupBy("line_host", "line").count()
    # A line of one page only stands on no other.
    often = counts.where("count > 1").join(totals, "line_host")
    return (
        often.where(F.col("count") - 1 > ratio * (F.col("pages") - 1))
        .groupBy("line_host")
        .agg(F.collect_list("line").alias("bad"))
    )


def without_boilerplate(pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO) -> DataFrame:
    """``pages`` with two more columns at the end: line_all and line_kept, arrays of lines in order.

    Null texts (null lines) give null arrays. An empty table gives no rows.
    Repeated pages count as pages of their own. Where ``pages`` has a column of
    one of these names, the new one gets an underscore after its name.
    """
    every, left, key, worst = (free_name(pages, n) for n in ("line_all", "line_kept", "line_host", "line_bad"))
    # Written first: its size is then known, so a small list is sent to the pages
    # instead of shuffling their texts.
    bad = staged(boilerplate(pages, host, lines, ratio), "boilerplate").toDF(key, worst)
    keyed = pages.withColumns({key: F.coalesce(host.cast("string"), F.lit("")), every: lines})
    kept = F.when(F.col(worst).isNull(), F.col(every)).otherwise(
        F.filter(every, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(worst), F.xxhash64(x)))
    )
    return keyed.join(bad, key, "left").select(*pages.columns, every, kept.alias(left))
