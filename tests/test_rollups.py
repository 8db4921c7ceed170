"""Distinct counts and totals that roll up, key maps of several sources, JSON paths."""

import pytest
from oracle import connect
from pyspark.sql import functions as F

from millrace.functions.text import json_paths, json_value
from millrace.operators import keymap, star
from millrace.operators.dimensions import split_parent
from millrace.operators.quality import QualityError
from millrace.plans import registry


def test_estimates_roll_up_within_the_bound(spark, folder):
    got = registry.queries()["approx_orders_rollup"](spark, folder).collect()
    exact = connect(folder).sql(
        """SELECT year(l_shipdate), month(l_shipdate), count(DISTINCT l_orderkey) FROM lineitem
           GROUP BY GROUPING SETS ((1, 2), (1))"""
    ).fetchall()
    assert {(r.ShipYear, r.ShipMonth, r.Orders) for r in got} == set(exact) and len(got) == len(exact)
    assert all(r.WithinTwoPercent and abs(r.Estimate - r.Orders) <= 0.02 * r.Orders for r in got)


def test_only_stored_sketches_are_read_by_the_roll_up(spark, folder, plan):
    text = plan(registry.queries()["approx_orders_rollup"](spark, folder))
    assert "orders.parquet" not in text


def test_merged_sketches_count_shared_values_once(spark):
    facts = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("k"))
    days = star.distinct_sketches(facts, ["day"], "k")
    whole = star.merged_sketches(days, [], "n").first()["n"]
    assert abs(whole - 20_000) <= 400
    assert star.merged_sketches(star.distinct_sketches(facts.where("false"), ["day"], "k"), ["day"], "n").count() == 0


def test_bitmaps_are_exact_at_every_level(spark, rows):
    data = [("a", 1, k) for k in (1, 2, 32768, 32769, 10**12, None, 2)] + [("a", 2, k) for k in (2, 3)] + [("b", 1, None), ("b", 2, 5)]
    facts = spark.createDataFrame(data, "g string, q int, k bigint")
    bitmaps = star.distinct_bitmaps(facts, ["g", "q"], "k")
    assert rows(star.merged_bitmaps(bitmaps, ["g", "q"], "n")) == [("a", 1, 5), ("a", 2, 2), ("b", 2, 1)]
    assert rows(star.merged_bitmaps(bitmaps, ["g"], "n")) == [("a", 6), ("b", 1)]


def test_subtotals_tell_levels_from_nulls(spark, rows):
    sums = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, None, 4)], "g string, h string, m int")
    found = star.subtotals(sums, ["g", "h"], "m")
    assert rows(found) == sorted(
        [(0, None, None, 7), (1, "a", None, 3), (1, None, None, 4), (2, "a", "x", 1), (2, "a", None, 2), (2, None, None, 4)], key=repr
    )


def test_hashed_parents_need_no_numbering(spark, rows, plan):
    child = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "a", None), (4, "b", "c")], "id int, p string, q string")
    parent, slim = split_parent(child, ["p", "q"], "k", hashed=True)
    assert parent.count() == parent.select("k").distinct().count() == 3
    assert "Join" not in plan(slim) and rows(slim.join(parent, "k").select("id", "p", "q")) == rows(child)


STAGED = "src string, no int, name string, at int"


def test_members_of_several_sources(spark, rows):
    staged = spark.createDataFrame(
        [("x", 1, "old", 1), ("x", 1, "new", 2), ("x", 1, "new", 2), ("y", 1, "other", 1), ("y", 2, "b", 1), ("y", 2, "c", 1)], STAGED
    )
    members = keymap.resolve(staged, "src", "no", F.col("at"))
    assert rows(members) == [("x", 1, "new", 2, 2), ("y", 1, "other", 1, 1), ("y", 2, "c", 1, 2)]
    empty = spark.createDataFrame([], "key bigint, src string, no int")
    first = keymap.extended_map(empty, staged.where("src = 'y'"), "src", "no", "key")
    known = keymap.extended_map(first, members, "src", "no", "key")
    assert rows(first) == [(1, "y", 1), (2, "y", 2)] and rows(known) == [(1, "y", 1), (2, "y", 2), (3, "x", 1)]
    assert rows(keymap.extended_map(known, members, "src", "no", "key")) == rows(known)
    dimension = keymap.integrated(known, members, "src", "no")
    assert {(r["src"], r["no"]): r[keymap.SHARED] for r in dimension.collect()} == {("x", 1): 2, ("y", 1): 2, ("y", 2): 1}
    assert keymap.conflicts(dimension).count() == 3
    with pytest.raises(QualityError):
        keymap.resolve(spark.createDataFrame([("x", None, "a", 1)], STAGED), "src", "no", F.col("at"))


def test_json_paths_and_types(spark):
    documents = ['{"a": {"b": [1, "x"]}, "c": "7"}', '{"a": 5, "c": 7.5}', "broken {", None, "[1]", '{"c": null}']
    df = spark.createDataFrame([(d,) for d in documents], "d string")
    paths = {"b": ("$.a.b[1]", "string"), "a": ("$.a", "int"), "c": ("$.c", "double"), "kind": ("$.a", "kind"), "ckind": ("$.c", "kind")}
    got = [tuple(r)[1:] for r in json_paths(df, "d", paths).collect()]
    assert got[0] == ("x", None, 7.0, "OBJECT", "STRING") and got[1] == (None, 5, 7.5, "BIGINT", "DECIMAL")
    assert got[2] == got[3] == got[4] == (None,) * 5 and got[5] == (None, None, None, None, "VOID")


def test_a_document_is_parsed_once(spark, plan):
    df = spark.createDataFrame([('{"a": 1}',)], "d string")
    text = json_paths(df, "d", {"a": ("$.a", "int"), "b": ("$.b", "int"), "k": ("$.a", "kind")})._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parseJson") + text.count("parse_json") == 1
    assert json_value(F.col("d"), "$.a") is not None
