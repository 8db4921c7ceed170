"""Plans of the queries: what reaches the scan, what is shuffled."""

import re

import pytest

from millrace.operators.star import sum_by
from millrace.plans import registry


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _query(spark, folder, name):
    return registry.queries()[name](spark, folder)


def test_only_needed_columns_are_read(spark, folder, plan):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(_query(spark, folder, "star_sales_by_quarter")))
    assert schemas and all(len(s.split(",")) <= 3 for s in schemas)


def test_filters_reach_the_scan(spark, folder, plan):
    assert "In(p_type, [ECONOMY,PROMO])" in plan(_query(spark, folder, "filter_in_list"))


def test_a_point_lookup_reaches_the_scan(spark, folder, plan):
    assert "EqualTo(c_custkey,7)" in plan(_query(spark, folder, "point_lookup"))


def test_partition_predicate_prunes_folders(spark, folder, plan):
    text = plan(_query(spark, folder, "filter_partition_pruned"))
    assert re.search(r"PartitionFilters: \[isnotnull\(Year.*= 2000", text)


def test_anti_join_is_one(spark, folder, plan):
    assert "LeftAnti" in plan(_query(spark, folder, "anti_join_unstaged"))


def test_top_n_does_not_sort_everything(spark, folder, plan):
    assert "TakeOrderedAndProject" in plan(_query(spark, folder, "top_n"))


@pytest.mark.parametrize("name", ["star_sales_by_quarter", "star_sales_by_quarter_city"])
def test_lines_are_summed_before_their_first_shuffle(spark, folder, plan, no_broadcast, name):
    lines = plan(_query(spark, folder, name)).split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet [l_orderkey" in line)
    above = next(line for line in reversed(lines[:scan]) if "Exchange" in line or "partial_sum" in line)
    assert "partial_sum" in above


def test_no_cartesian_products(spark, folder, plan):
    for name in ("star_sales_by_quarter_city", "fact_sales_build", "dim_scd2", "rank_products"):
        text = plan(_query(spark, folder, name))
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_a_crowded_key_is_one_row_per_task_in_the_shuffle(spark):
    facts = spark.range(0, 30_000, numPartitions=4).selectExpr("IF(id % 3 = 0, -1, id % 50) AS k", "id AS v")
    summed = sum_by(facts, ["k"], "v")
    summed.collect()
    shuffled = []

    def visit(node):
        metrics = node.metrics()
        if node.nodeName() == "Exchange":
            shuffled.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            visit(node.executedPlan())
        if "QueryStage" in node.nodeName():
            visit(node.plan())

    visit(summed._jdf.queryExecution().executedPlan())
    assert shuffled == [4 * 51]
