"""The queries on tables where one order, product and customer hold a third of the rows."""

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from millrace.plans import registry, relational, warehouse
from millrace.session import scratch


@pytest.fixture(scope="module")
def skewed(spark, folder):
    target = scratch(spark, "skewed")
    third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("hot", third)
    lines = lines.withColumns({c: F.when(F.col("hot"), 1).otherwise(F.col(c)) for c in ("l_orderkey", "l_partkey", "l_suppkey")})
    # Several files, so that a crowded shuffle partition comes from several tasks.
    lines.drop("hot").repartition(8).write.parquet(f"{target}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customer = F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0, 1).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", customer).write.parquet(f"{target}/orders.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet")
    kind = F.when(F.pmod(F.xxhash64("p_partkey"), F.lit(3)) == 0, "PROMO").otherwise(F.col("p_type"))
    parts.withColumn("p_type", kind).write.parquet(f"{target}/part.parquet")
    for name in ("customer", "supplier", "nation", "region", "events"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{target}/{name}.parquet")
    return target


@pytest.fixture
def small_partitions(spark):
    """Let adaptive execution see this little data as it would see very large tables."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "0",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


NAMES = [
    "star_sales_by_quarter", "star_sales_by_quarter_city", "snowflake_items_by_category", "rank_products",
    "rank_stores_by_year", "distinct_orders_by_year", "fact_sales_build", "fact_point_in_time_key", "check_unique",
    "check_referential", "layout_hash", "layout_replicate_join", "dim_snowflake_split", "filter_equality",
]


@pytest.mark.parametrize("name", NAMES)
def test_values_hold_on_crowded_keys(spark, skewed, small_partitions, name):
    query, sql = registry.queries()[name], registry.oracle_sql()[name]
    assert differences(query(spark, skewed), connect(skewed), sql) is None


@pytest.mark.parametrize("query", [relational.revenue_by_store, warehouse.fact_sales_build])
def test_a_crowded_order_is_split_over_tasks(spark, skewed, small_partitions, query):
    df = query(spark, skewed)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
