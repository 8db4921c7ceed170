"""Building and maintaining dimension tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.dates import calendar_columns
from millrace.operators.keys import append_members, assign_keys, new_members
from millrace.operators.quality import require_business_key, require_constraints, require_unique
from millrace.session import scratch

OPEN_END = dt.date(9999, 12, 31)


def date_dimension(bounds: DataFrame, fiscal_start_month: int = 7) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame.

    The days come from one ``sequence``; a calendar is a few thousand rows.
    """
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("d"))
    columns = calendar_columns(F.col("d"), fiscal_start_month)
    return days.select(*[column.alias(name) for name, column in columns.items()])


def date_bounds(facts: DataFrame, column: str) -> DataFrame:
    """First and last day a fact column mentions."""
    day = F.col(column).cast("date")
    return facts.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def extend_date_dimension(dimension: DataFrame, facts: DataFrame, column: str, fiscal_start_month: int = 7) -> DataFrame:
    """The dimension plus the days up to the newest fact."""
    last = dimension.agg(F.max("DateAltKey")).first()[0]
    newest = date_bounds(facts, column).select(
        F.date_add(F.lit(last), 1).alias("first_day"), "last_day"
    ).where("last_day >= first_day")
    return dimension.unionByName(date_dimension(newest, fiscal_start_month))


def time_dimension(spark: SparkSession, first: dt.datetime, last: dt.datetime, grain_seconds: int = 3600) -> DataFrame:
    """One row per interval; generated in parallel, so a fine grain is no problem."""
    utc = dt.timezone.utc
    first, last = (t.astimezone(utc) if t.tzinfo else t.replace(tzinfo=utc) for t in (first, last))
    begin, end = int(first.timestamp()) // grain_seconds, int(last.timestamp()) // grain_seconds
    # The key is as fine as the grain, so it is unique.
    digits = "yyyyMMddHH" + ("" if grain_seconds % 3600 == 0 else "mm" if grain_seconds % 60 == 0 else "mmss")
    origin = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    seconds = F.col("id") * grain_seconds
    moment = origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    day = F.col("t").cast("date")
    return (
        spark.range(begin, end + 1)
        .select(moment.alias("t"))
        .select(
            F.date_format("t", digits).cast("bigint").alias("TimeKey"),
            day.alias("DateAltKey"),
            F.hour("t").alias("HourOfDay"),
            F.minute("t").alias("MinuteOfHour"),
            F.second("t").alias("SecondOfMinute"),
        )
    )


def full_load(staged: DataFrame, mapping: dict[str, str], business_key: str, key: str) -> DataFrame:
    """First load: staging columns renamed to dimension columns, keys 1..n."""
    renamed = staged.select(*[F.col(source).alias(target) for source, target in mapping.items()])
    return assign_keys(renamed, [business_key], key)


def upsert(dimension: DataFrame, staged: DataFrame, business_key: str, key: str) -> DataFrame:
    """Rebuilt dimension: staged rows replace or extend the existing ones.

    A known member keeps its surrogate key, a new one gets the next free key.
    Meant for one row per member; write the result beside the old table and swap.
    """
    require_business_key(staged, business_key, "staged rows")
    attributes = [c for c in dimension.columns if c != key]
    staged = staged.select(*attributes)
    updated = staged.join(dimension.select(key, business_key), business_key)
    untouched = dimension.join(staged.select(business_key), business_key, "left_anti")
    added = append_members(dimension, new_members(staged, dimension, [business_key]), [business_key], key)
    columns = dimension.columns
    return updated.select(*columns).unionByName(untouched.select(*columns)).unionByName(added)


def _differs(attributes: list[str]) -> Column:
    changed = F.lit(False)
    for c in attributes:
        changed = changed | ~F.col(f"cur.{c}").eqNullSafe(F.col(f"stg.{c}"))
    return changed


def start_history(members: DataFrame, business_key: str, key: str, valid_from: dt.date) -> DataFrame:
    """History-keeping dimension from its first load."""
    return assign_keys(members, [business_key], key).select(
        "*",
        F.lit(valid_from).alias("ValidFrom"),
        F.lit(OPEN_END).alias("ValidTo"),
        F.lit(True).alias("IsCurrent"),
    )


def keep_history(dimension: DataFrame, staged: DataFrame, business_key: str, key: str, changed_on: dt.date) -> DataFrame:
    """Close the current row of every changed member and add a new one.

    Validity is half open: a row holds for ``ValidFrom <= day < ValidTo``. New
    members are added as well; members whose attributes agree stay as they are.
    A change dated before the current row of its member, or on the day that row
    began, raises and names the member: ``split_history`` takes such changes.
    """
    require_business_key(staged, business_key, "staged rows")
    columns = dimension.columns
    own = {key, business_key, "ValidFrom", "ValidTo", "IsCurrent"}
    attributes = [c for c in columns if c not in own]
    current = dimension.where("IsCurrent").alias("cur")
    same_member = F.col(f"stg.{business_key}") == F.col(f"cur.{business_key}")
    late = F.concat(F.lit("change not after the current row of "), F.col(f"stg.{business_key}").cast("string"))
    since = F.when(F.col("cur.ValidFrom") >= F.lit(changed_on), F.raise_error(late)).otherwise(F.lit(changed_on))
    arriving = (
        staged.alias("stg")
        .join(current, same_member, "left")
        .where(F.col(f"cur.{key}").isNull() | _differs(attributes))
        .select(
            f"stg.{business_key}",
            *[f"stg.{c}" for c in attributes],
            since.alias("ValidFrom"),
            F.lit(OPEN_END).alias("ValidTo"),
            F.lit(True).alias("IsCurrent"),
        )
    )
    # Numbered rows are stored, so closing the old rows reads them back instead
    # of comparing the members again.
    added = append_members(dimension, arriving, [business_key], key)
    flagged = dimension.join(added.select(business_key, F.lit(True).alias("_changed")), business_key, "left")
    closing = F.col("IsCurrent") & F.coalesce("_changed", F.lit(False))
    kept = flagged.withColumns(
        {
            "ValidTo": F.when(closing, F.lit(changed_on)).otherwise(F.col("ValidTo")),
            "IsCurrent": F.col("IsCurrent") & ~closing,
        }
    )
    return kept.select(*columns).unionByName(added)


def _written(df: DataFrame, label: str) -> DataFrame:
    df.write.parquet(path := scratch(df.sparkSession, label))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_history(dimension: DataFrame, changes: DataFrame, business_key: str, key: str, changed_on: str) -> DataFrame:
    """Fit changes into a history, whenever they took effect.

    ``changes`` has the attributes of members and the day ``changed_on`` from which
    they held; a member may change several times in one load, also before rows
    that are there already. A change splits the row it falls into; one on the day a
    row began replaces that row's attributes in place. Neighbours that agree become
    one row, which keeps the key of its first row that had one. No row is empty,
    none overlap; other members are not touched. Repeated changes count once; two
    different ones of a member on one day, or one without a member or day, raise.
    """
    columns = dimension.columns
    own = {key, business_key, "ValidFrom", "ValidTo", "IsCurrent"}
    attributes = [c for c in columns if c not in own]
    arriving = changes.select(business_key, F.col(changed_on).cast("date").alias("ValidFrom"), *attributes).distinct()
    # Written: it is checked, fitted in, and tells which members are touched.
    arriving = _written(arriving, "changes")
    require_unique(arriving, [business_key, "ValidFrom"], "changes")
    require_constraints(arriving, [business_key, "ValidFrom"], {}, "changes")
    members = arriving.select(business_key).distinct()
    state = F.struct(*attributes).alias("state")
    known = dimension.join(members, business_key, "left_semi").select(
        business_key, "ValidFrom", state, F.col(key).alias("key"), F.col("ValidTo").alias("until"), F.lit(0).alias("late")
    )
    fresh = arriving.select(business_key, "ValidFrom", state, F.lit(1).alias("late"))
    days = known.unionByName(fresh, allowMissingColumns=True).groupBy(business_key, "ValidFrom").agg(
        F.max_by("state", "late").alias("state"), F.max("key").alias("key"), F.max("until").alias("until")
    )
    along = Window.partitionBy(business_key).orderBy("ValidFrom")
    # The end of the row a change falls into; a change after a member's end opens it again.
    until = F.last("until", ignorenulls=True).over(along)
    until = F.when(until > F.col("ValidFrom"), until).otherwise(F.lit(OPEN_END))
    ends = F.least(until, F.coalesce(F.lead("ValidFrom").over(along), F.lit(OPEN_END)))
    agrees = F.lag("state").over(along).eqNullSafe(F.col("state")) & (F.lag("ends").over(along) == F.col("ValidFrom"))
    first = ~F.coalesce(agrees, F.lit(False))
    numbered = days.withColumn("ends", ends).withColumn("run", F.sum(first.cast("int")).over(along))
    keyed = F.when(F.col("key").isNotNull(), F.col("ValidFrom"))
    rows = numbered.groupBy(business_key, "run").agg(
        F.min("ValidFrom").alias("ValidFrom"), F.max("ends").alias("ValidTo"), F.first("state").alias("state"),
        F.min_by("key", keyed).alias(key),
    ).select(
        key, business_key, "state.*", "ValidFrom", "ValidTo", (F.col("ValidTo") == F.lit(OPEN_END)).alias("IsCurrent")
    ).select(*columns)
    rows = _written(rows, "history")
    added = append_members(dimension, rows.where(F.col(key).isNull()), [business_key, "ValidFrom"], key)
    untouched = dimension.join(members, business_key, "left_anti")
    return untouched.select(*columns).unionByName(rows.where(F.col(key).isNotNull())).unionByName(added)


def split_parent(child: DataFrame, attributes: list[str], key: str, hashed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Move attributes into a parent dimension; returns (parent, child with its key).

    The keys are 1, 2, ... in order of the attributes. With ``hashed`` they are
    64-bit hashes of the attributes: the same in every load, so nothing is numbered
    or written and the child needs no join. Two attribute tuples of one hash would
    give a parent with two rows of one key; check it by ``quality.require_unique``.
    """
    rest = [c for c in child.columns if c not in attributes]
    if hashed:
        own = F.xxhash64(*attributes, *[F.col(c).isNull() for c in attributes]).alias(key)
        return child.select(*attributes).distinct().select(own, *attributes), child.select(own, *rest)
    parent = assign_keys(child.select(*attributes).distinct(), attributes, key)
    matches = F.lit(True)
    for c in attributes:
        matches = matches & F.col(f"child.{c}").eqNullSafe(F.col(f"parent.{c}"))
    slim = child.alias("child").join(parent.alias("parent"), matches).select(F.col(f"parent.{key}"), *[F.col(f"child.{c}") for c in rest])
    return parent, slim
