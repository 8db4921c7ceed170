"""Histories with late changes, and keys as of a day, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import dimensions
from millrace.operators.facts import Lookup, as_of
from millrace.operators.quality import QualityError

DAY = dt.date(2020, 1, 1)
SCHEMA = "Key bigint, No string, City string, ValidFrom date, ValidTo date, IsCurrent boolean"


def day(n):
    return DAY + dt.timedelta(days=n)


def history(spark, rows):
    """Rows (key, member, city, from, to or None)."""
    return spark.createDataFrame(
        [(k, m, c, day(a), dimensions.OPEN_END if b is None else day(b), b is None) for k, m, c, a, b in rows], SCHEMA
    )


def changes(spark, rows):
    return spark.createDataFrame([(m, c, None if n is None else day(n)) for m, c, n in rows], "No string, City string, Since date")


def fitted(spark, rows, new):
    found = dimensions.split_history(history(spark, rows), changes(spark, new), "No", "Key", "Since")
    out = [(r.Key, r.No, r.City, (r.ValidFrom - DAY).days, None if r.IsCurrent else (r.ValidTo - DAY).days) for r in found.collect()]
    return sorted(out, key=lambda r: (r[1], r[3]))


BASE = [(1, "a", "x", 0, 10), (2, "a", "y", 10, None), (3, "b", "x", 0, None)]


def test_a_late_change_splits_the_row_it_falls_into(spark):
    assert fitted(spark, BASE, [("a", "z", 4)]) == [(1, "a", "x", 0, 4), (4, "a", "z", 4, 10), (2, "a", "y", 10, None), (3, "b", "x", 0, None)]


def test_several_changes_in_one_load_and_new_members(spark):
    got = fitted(spark, BASE, [("b", "p", 5), ("b", "q", 7), ("b", "q", 9), ("c", "n", 3), ("c", "n", 3)])
    assert got == [
        (1, "a", "x", 0, 10), (2, "a", "y", 10, None), (3, "b", "x", 0, 5), (4, "b", "p", 5, 7), (5, "b", "q", 7, None),
        (6, "c", "n", 3, None),
    ]


def test_a_change_on_the_first_day_replaces_in_place(spark):
    got = fitted(spark, BASE, [("b", "w", 0), ("a", "x", 10)])
    # The second row of a agrees with the first now: one row, with the first key.
    assert got == [(1, "a", "x", 0, None), (3, "b", "w", 0, None)]


def test_an_earlier_change_keeps_the_existing_key(spark):
    assert fitted(spark, [(8, "a", "x", 5, None)], [("a", "x", 2), ("a", "w", 0)]) == [(9, "a", "w", 0, 2), (8, "a", "x", 2, None)]


def test_a_history_that_ended(spark):
    rows = [(1, "a", "x", 0, 5), (2, "a", "y", 8, 12)]
    got = fitted(spark, rows, [("a", "z", 3), ("a", "y", 20)])
    assert got == [(1, "a", "x", 0, 3), (3, "a", "z", 3, 5), (2, "a", "y", 8, 12), (4, "a", "y", 20, None)]


def test_contradicting_or_incomplete_changes_raise(spark):
    for new in ([("a", "p", 3), ("a", "q", 3)], [("a", "p", None)], [(None, "p", 3)]):
        with pytest.raises(QualityError):
            fitted(spark, BASE, new)


def test_random_histories(spark):
    rng = random.Random(5)
    rows, new, key = [], [], 0
    for m in map(str, range(40)):
        starts = sorted(rng.sample(range(60), rng.randrange(0, 5)))
        for a, b in zip(starts, [*starts[1:], None]):
            key += 1
            rows.append((key, m, rng.choice("pqr"), a, b))
        new += [(m, rng.choice("pqr"), n) for n in rng.sample(range(60), rng.randrange(0, 6))]
    got = fitted(spark, rows, new)
    for m in map(str, range(40)):
        mine = [r for r in got if r[1] == m]
        late = {n: c for x, c, n in new if x == m}
        old = {a: c for _, x, c, a, _ in rows if x == m}
        for n in range(70):
            at = [a for a in old if a <= n] + [a for a in late if a <= n]
            want = None if not at else late.get(max(at), old.get(max(at)))
            assert [r[2] for r in mine if r[3] <= n and (r[4] is None or n < r[4])] == ([] if want is None else [want])
        if late:
            assert all(x[2] != y[2] for x, y in zip(mine, mine[1:]))
        assert all(r[4] is None or r[3] < r[4] for r in mine)
    assert len({r[0] for r in got}) == len(got)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_as_of_against_every_row(spark, coalesce):
    """One member has a third of the facts and a long history; members and days may be NULL."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rng = random.Random(3)
        rows = [(i, "hot", "x", i, i + 1) for i in range(500)] + [(900, "a", "x", 3, 7), (901, "a", "y", 9, None), (902, "b", "x", 0, None)]
        facts = [(i, rng.choice(["hot", "hot", "a", "b", "none", None]), None if i % 17 == 0 else rng.randrange(-5, 520)) for i in range(1500)]
        df = spark.createDataFrame([(i, m, None if n is None else day(n)) for i, m, n in facts], "id int, who string, at date")
        df = df.withColumn("_at", F.lit("own"))
        got = {r.id: r.Key for r in as_of(df, F.col("at"), Lookup("who", history(spark, rows), "No", "Key")).collect()}
        for i, m, n in facts:
            valid = [k for k, x, _, a, b in rows if x == m and n is not None and a <= n and (b is None or n < b)]
            assert got[i] == (valid[0] if valid else None)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_as_of_shuffles_facts_once(spark, plan):
    df = spark.createDataFrame([(1, "a", day(3))], "id int, who string, at date")
    text = plan(as_of(df, F.col("at"), Lookup("who", history(spark, BASE), "No", "Key")))
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text[: text.index("BroadcastExchange")]
