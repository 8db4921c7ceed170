import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.catalog import tables as definitions
from millrace.operators.layout import measured_bytes, replicated, round_robin, save_hashed
from millrace.operators.quality import QualityError
from millrace.plans.registry import queries
from millrace.session import scratch
from millrace.sinks import folders, tables


def test_a_folder_can_replace_itself(spark, path, rows):
    target = f"{path}/orders.parquet"
    folders.replace_folder(spark.range(3), target)
    folders.replace_folder(spark.read.parquet(target).selectExpr("id * 10 AS id"), target)
    assert rows(spark.read.parquet(target)) == [(0,), (10,), (20,)]
    assert os.listdir(path) == ["orders.parquet"]


def test_only_written_partitions_are_replaced(spark, path, rows):
    folders.replace_folder(spark.range(4).selectExpr("id", "id % 2 AS y"), path, ["y"])
    folders.replace_partitions(spark.createDataFrame([(99, 1)], "id bigint, y bigint"), path, ["y"])
    assert rows(spark.read.parquet(path).select("id", "y")) == [(0, 0), (2, 0), (99, 1)]


def _csv(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as file:
        file.write(text)


BAD_ROWS = "1,a,1.5\nx,b,2.5\n3,c\n4,d,4.5\n"


def test_bulk_load_counts_bad_rows(spark, path, database, rows):
    name = f"{database}.Stage"
    definitions.create_table(spark, name, "id INT, t STRING, price DOUBLE, extra STRING")
    _csv(path, "rows.csv", BAD_ROWS)
    columns = ["id", "t", "price"]
    with pytest.raises(Exception):
        tables.copy_into(spark, name, columns, path, "CSV")
    with pytest.raises(tables.TooManyErrors):
        tables.copy_into(spark, name, columns, path, "CSV", max_errors=1)
    assert spark.table(name).count() == 0
    tables.copy_into(spark, name, columns, path, "CSV", max_errors=2)
    assert rows(spark.table(name)) == [(1, "a", 1.5, None), (4, "d", 4.5, None)]


def test_bulk_load_makes_its_own_keys(spark, path, database, rows):
    name = f"{database}.Dim"
    definitions.create_table(spark, name, "key BIGINT, code STRING")
    spark.createDataFrame([(500, "b"), (600, "a")], "key bigint, code string").write.parquet(path)
    for _ in range(2):
        tables.copy_into(spark, name, ["key", "code"], f"{path}/*.parquet", identity=("key", ["code"]))
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]


def test_constraints_are_checked_before_anything_lands(spark, database, rows):
    name = f"{database}.Checked"
    definitions.create_table(spark, name, "id INT NOT NULL, t STRING")
    rules = {"not_null": ["id"], "max_lengths": {"t": 3}}
    for bad in ((None, "a"), (1, "long")):
        with pytest.raises(QualityError):
            tables.insert_checked(spark.createDataFrame([(2, "ok"), bad], "id int, t string"), name, **rules)
    assert spark.table(name).count() == 0
    tables.insert_checked(spark.createDataFrame([("ok", 2), (None, 3)], "t string, id int"), name, **rules)
    assert rows(spark.table(name)) == [(2, "ok"), (3, None)]


def test_a_small_result_goes_to_pandas(spark, folder):
    counts = queries()["group_count_column"](spark, folder).toPandas()
    assert list(counts.columns) == ["Category", "ProductCount"] and counts.Category.is_monotonic_increasing


def test_rebuild_reads_the_table_it_replaces(spark, path, database, rows):
    name, target = f"{database}.Special", f"{path}/special"
    tables.rebuild_external(spark, name, target, "SELECT id FROM range(:n)", n=5)
    tables.rebuild_external(spark, name, target, f"SELECT id FROM {name} WHERE id >= :least", least=3)
    assert rows(spark.table(name)) == [(3,), (4,)]
    assert os.listdir(path) == ["special"]


def test_swap_keeps_the_archive(spark, database, rows):
    tables.save_managed(spark.range(1), f"{database}.a")
    tables.save_managed(spark.range(2), f"{database}.b")
    tables.swap(spark, f"{database}.a", f"{database}.b", f"{database}.old")
    assert spark.table(f"{database}.a").count() == 2 and spark.table(f"{database}.old").count() == 1
    assert not spark.catalog.tableExists(f"{database}.b")


def test_builder_and_guards(spark, database):
    def builder():
        return definitions.TableBuilder(spark, f"{database}.t").column("id", "INT", nullable=False).column("t", "STRING")

    assert builder().create().dtypes == [("id", "int"), ("t", "string")]
    with pytest.raises(AnalysisException):
        builder().create()
    spark.sql(f"INSERT INTO {database}.t VALUES (1, 'x')")
    assert builder().create_if_missing().count() == 1
    assert builder().create_or_replace().count() == 0


def test_using_restores_the_database(spark, database):
    before = spark.catalog.currentDatabase()
    with pytest.raises(RuntimeError), definitions.using(spark, database):
        assert spark.catalog.currentDatabase() == database
        raise RuntimeError
    assert spark.catalog.currentDatabase() == before


# ---- placement --------------------------------------------------------------

def test_equally_hashed_tables_join_without_a_shuffle(spark, database, plan):
    for name in ("l", "r"):
        df = spark.range(2000).selectExpr("id", "id * 2 AS v")
        save_hashed(df, f"{database}.{name}", "id", 4, scratch(spark, "hashed"))
    left, right = spark.table(f"{database}.l"), spark.table(f"{database}.r")
    joined = left.hint("merge").join(right, "id")
    assert "Exchange" not in plan(joined) and joined.count() == 2000


def test_a_crowded_key_is_hashed_as_asked(spark, database, rows):
    skewed = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"))
    save_hashed(skewed, f"{database}.s", "id", 16, scratch(spark, "hashed"))
    assert rows(spark.table(f"{database}.s")) == rows(skewed)
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {database}.s").collect()}
    assert described["Num Buckets"] == "16"


def test_measuring_a_side_needs_no_single_task_of_rows(spark, plan):
    assert measured_bytes(spark.range(5).selectExpr("array(id) AS a")) is None
    assert measured_bytes(spark.range(0)) == 0


@pytest.mark.parametrize("partition_by", [None, ["p"]])
def test_an_external_table_can_be_saved_from_its_own_files(spark, database, path, partition_by):
    rows = spark.range(100).selectExpr("id", "cast(id % 3 AS string) AS p")
    tables.save_external(rows, f"{database}.own", path, partition_by)
    kept = tables.save_external(spark.read.schema(rows.schema).parquet(path).where("id < 50"), f"{database}.own", path, partition_by)
    assert kept.count() == 50 and dict(kept.dtypes) == dict(rows.dtypes)


def test_a_failed_swap_leaves_the_table_readable(spark, database):
    tables.save_managed(spark.range(3), f"{database}.cur")
    with pytest.raises(Exception, match="missing"):
        tables.swap(spark, f"{database}.cur", f"{database}.missing", f"{database}.before")
    assert spark.table(f"{database}.cur").count() == 3


def test_one_verdict_per_row_in_a_bulk_load(spark, database, path):
    spark.createDataFrame([("x,1,a",), ("y,2,b",), ("3,3,c",), ("4,4,long",), ("5,,d",), ("6,six,e",)], "value string").coalesce(1).write.text(path)
    for limit, rules in ((1, {}), (2, {"not_null": ["code"]}), (3, {"not_null": ["code"], "max_lengths": {"name": 1}})):
        name = f"{database}.stage{limit}"
        spark.sql(f"CREATE TABLE {name} (k BIGINT, code BIGINT, name STRING) USING parquet")
        arguments = (spark, name, ["k", "code", "name"], path, "CSV")
        with pytest.raises(tables.TooManyErrors):
            tables.copy_into(*arguments, max_errors=limit - 1, identity=("k", ["name"]), **rules)
        assert spark.table(name).isEmpty()
        left_out = tables.copy_into(*arguments, max_errors=limit, identity=("k", ["name"]), **rules)
        assert left_out.count() == limit and spark.table(name).count() == 6 - limit


def test_broadcast_only_within_the_size(spark, plan):
    small = spark.range(100).selectExpr("id", "repeat('x', 100) AS t")
    facts = spark.range(1000).selectExpr("id % 100 AS id")
    assert 100 * 100 < measured_bytes(small) < 100 * 300
    assert measured_bytes(small, max_rows=99) is None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(facts.join(replicated(small), "id"))
        assert "SortMergeJoin" in plan(facts.join(replicated(small, max_bytes=1000), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_round_robin_is_even(spark):
    sizes = round_robin(spark.range(1000).coalesce(1), 4).groupBy(F.spark_partition_id()).count()
    assert {r[1] for r in sizes.collect()} <= {249, 250, 251}


@pytest.mark.parametrize("partition_by", [None, ["p"]])
def test_a_managed_table_is_not_replaced_by_an_external_one(spark, database, partition_by):
    name = f"{database}.kept"
    spark.range(100).selectExpr("id", "id % 3 AS p").write.saveAsTable(name, format="parquet", partitionBy=partition_by)
    place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()[1]
    rows = spark.read.parquet(place).where("id < 50")
    for save in (
        lambda: tables.save_external(rows, name, place, partition_by),
        lambda: tables.rebuild_external(spark, name, place, f"SELECT * FROM {name} WHERE id < :n", n=50),
    ):
        with pytest.raises(ValueError, match="MANAGED"):
            save()
        assert spark.table(name).count() == 100 and spark.read.parquet(place).count() == 100


def test_partitions_of_any_value_and_paths_with_quotes(spark, database, path, rows):
    data = [(1, "a b/c=d'e", "x"), (2, None, "100%"), (3, "é\\z", "y:z")]
    df = spark.createDataFrame(data, "id int, p string, q string")
    for by in (["p"], ["p", "q"]):
        table = tables.save_external(df, f"{database}.odd{len(by)}", f"{path}/it's {len(by)}", by)
        assert rows(table.select("id", "p", "q")) == sorted(data, key=repr)
        assert table.where("p = 'a b/c=d\\'e'").count() == 1 and table.where("p IS NULL").count() == 1
        assert spark.sql(f"SHOW PARTITIONS {database}.odd{len(by)}").count() == 3


def test_rejected_rows_carry_their_reasons(spark, path, database):
    name = f"{database}.Stage"
    definitions.create_table(spark, name, "id INT, t STRING, u STRING")
    _csv(path, "rows.csv", "1,a,\nx,b,c\n3,long,\n4,long,d\n5,ok,e\n")
    left_out = tables.copy_into(
        spark, name, ["id", "t", "u"], path, "CSV", max_errors=4, not_null=["u"], max_lengths={"t": 2}
    )
    found = {r["t"]: list(r[tables.REASONS]) for r in left_out.where("u IS NOT NULL").collect()}
    assert found == {"b": [tables.UNREADABLE], "long": ["t is longer than 2"]}
    both = left_out.where("id = 3").first()[tables.REASONS]
    assert list(both) == ["u is NULL", "t is longer than 2"] and spark.table(name).count() == 1


def test_files_are_parsed_once(spark, path, database, monkeypatch):
    """What the load and the rows left out read is the judged copy, not the files."""
    name = f"{database}.Stage"
    definitions.create_table(spark, name, "id INT, t STRING")
    _csv(path, "rows.csv", "1,a\nx,b\n")
    left_out = tables.copy_into(spark, name, ["id", "t"], path, "CSV", max_errors=1)
    os.remove(f"{path}/rows.csv")
    assert left_out.count() == 1 and spark.table(name).count() == 1
