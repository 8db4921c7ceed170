import pytest
from pyspark.sql import functions as F

from millrace.operators.ranking import rank_within

# Fixed values, a published sample listing: name, price, row number, rank, dense rank, quartile.
ACCESSORIES = [
    ("Widget", 8.99, 1, 1, 1, 1),
    ("Knicknak", 8.49, 2, 2, 2, 1),
    ("Sprocket", 5.99, 3, 3, 3, 2),
    ("Doodah", 5.99, 4, 3, 3, 2),
    ("Spangle", 2.99, 5, 5, 4, 3),
    ("Badabing", 0.25, 6, 6, 5, 4),
]


@pytest.mark.parametrize("windows", [True, False])
def test_sample_listing(spark, rows, windows):
    listed = [("Accessories", i, name, price) for i, (name, price, *_) in enumerate(ACCESSORIES)]
    df = spark.createDataFrame(listed, "category string, line int, name string, price double")
    ranked = rank_within(df, ["category"], "price", ["line"], windows=windows)
    assert rows(ranked.drop("category", "line")) == sorted(ACCESSORIES, key=repr)


@pytest.mark.parametrize("tiles", [1, 4, 7])
@pytest.mark.parametrize("descending", [True, False])
def test_distributed_form_equals_window_functions(spark, rows, tiles, descending):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # A third of the rows in one group, half of those with one value; NULL
        # groups and values; groups smaller than the number of tiles.
        df = spark.range(3000).select(
            "id",
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 31 == 1, None)
            .otherwise(F.concat(F.lit("g"), (F.col("id") % 500).cast("string"))).alias("g"),
            F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 17 == 3, None).otherwise(F.col("id") % 40).alias("v"),
        )
        arguments = (df, ["g"], "v", ["id"], descending, tiles)
        native = rank_within(*arguments, windows=True)
        assert rows(rank_within(*arguments)) == rows(native)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_caller_chooses_the_form(spark, plan):
    df = spark.createDataFrame([("a", 1, 1)], "g string, v int, id int")
    assert "_range" not in plan(rank_within(df, ["g"], "v", ["id"], windows=True))
    ranged = plan(rank_within(df, ["g"], "v", ["id"]))
    # Rows are read from their ranges and not shuffled again; only the carried table is exchanged.
    rows = ranged[: ranged.index("BroadcastExchange")]
    assert "_range" in rows and "Exchange hashpartitioning" not in rows and "SortMergeJoin" not in ranged


def test_a_run_over_many_ranges(spark, rows):
    """One value fills several ranges, with others before and after; NaN, negative zero and NULL are values too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = [float("nan"), -0.0, 0.0, None, 3.5]
        df = spark.createDataFrame(
            [(i, "a" if i % 10 else "b", values[i % 5] if i % 50 < 5 else 7.0) for i in range(4000)], "id int, g string, v double"
        )
        for descending in (True, False):
            native = rank_within(df, ["g"], "v", ["id"], descending, windows=True)
            # NaN is unequal to itself in Python.
            ours = rank_within(df, ["g"], "v", ["id"], descending).withColumn("v", F.col("v").cast("string"))
            assert rows(ours) == rows(native.withColumn("v", F.col("v").cast("string")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v int, id int")
    assert rank_within(df, ["g"], "v", ["id"]).count() == 0


def test_a_group_is_needed(spark):
    with pytest.raises(ValueError):
        rank_within(spark.range(1), [], "id", [])
