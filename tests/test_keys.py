import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import keys
from millrace.operators.keys import append_members, assign_keys, new_members, next_key, ordered_positions


@pytest.fixture
def many_ranges(spark):
    """Keep small range partitions apart, as large ones would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_positions_equal_a_global_window(spark, folder, many_ranges):
    df = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    order = [F.col("o_custkey").desc(), F.col("o_orderkey").asc()]
    ours = ordered_positions(df, order, "position")
    expected = df.withColumn("expected", F.row_number().over(Window.orderBy(*order)))
    wrong = ours.join(expected, ["o_orderkey", "o_custkey"]).where("position <> expected")
    assert wrong.count() == 0
    assert ours.count() == df.count()


def test_a_heavily_repeated_value_is_spread_over_ranges(spark, many_ranges):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    numbered = ordered_positions(df, [F.col("k").asc()], "position")
    ranges = spark.read.parquet(*numbered.inputFiles())
    assert ranges.where("k = 7").select(F.input_file_name()).distinct().count() > 1
    total = numbered.agg(F.count_distinct("position"), F.min("position"), F.max("position")).first()
    assert tuple(total) == (20_000, 1, 20_000)
    lags = numbered.select("k", F.lag("k").over(Window.orderBy("position")).alias("previous"))
    assert lags.where("previous > k").count() == 0


def test_identical_copies_keep_distinct_positions_after_a_shuffle(spark, many_ranges):
    df = spark.range(3000).select(F.lit("same").alias("k")).repartition(5)
    numbered = ordered_positions(df, [F.col("k").asc()], "position")
    assert numbered.agg(F.count_distinct("position")).first()[0] == 3000


def test_keys_start_at_one_and_follow_nulls_first(spark, rows):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "name string")
    assert rows(assign_keys(df, ["name"], "key")) == [(1, None), (2, "a"), (3, "b")]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "name string")
    assert assign_keys(empty, ["name"], "key").count() == 0
    assert next_key(spark.createDataFrame([], "key bigint"), "key") == 1


def test_appended_members_continue_the_keys(spark, rows):
    dimension = spark.createDataFrame([(7, "a"), (3, "b")], "key bigint, name string")
    staged = spark.createDataFrame([("d",), ("a",), ("c",)], "name string")
    added = append_members(dimension, new_members(staged, dimension, ["name"]), ["name"], "key")
    assert rows(added) == [(8, "c"), (9, "d")]


def test_only_frames_straight_from_files_are_not_copied(spark, path):
    spark.range(20).withColumn("Exchange", F.lit(1)).write.parquet(path)
    files = spark.read.parquet(path)
    assert keys.stored(files.where("Exchange = 1")).inputFiles() == files.inputFiles()
    kept = files.where("id < 9").cache()
    for name, unsteady in {"shuffled": files.repartition(2), "cut": files.limit(5), "cached": kept}.items():
        assert keys.stored(unsteady).inputFiles() != files.inputFiles(), name
    kept.unpersist()
