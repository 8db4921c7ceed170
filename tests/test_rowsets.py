import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.paths import filepath
from millrace.functions.text import json_value, split_name
from millrace.sources import rowsets
from millrace.sources.lake import Lake, delimited_format, parquet_format


@pytest.fixture
def put(path):
    """Write a small text file below the test's folder."""

    def write(name, text):
        target = os.path.join(path, name)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w", newline="") as file:
            file.write(text)
        return target

    return write


BIKES = (
    "ProductID,ProductName,Category,ListPrice\n"
    '771,"Mountain-100 Silver, 38",Mountain Bikes,3399.9900\n'
    '772,"Mountain-100 Silver, 42",Mountain Bikes,3399.9900\n'
)
SHOP = "product_id,product_name,list_price\r\n123,Widget,12.99\r\n124,Gadget,3.99\r\n"
WIDGETS = [(123, "Widget", 12.99), (124, "Gadget", 3.99)]


def test_untyped_header(spark, put, rows):
    df = rowsets.untyped(spark, put("products.csv", BIKES))
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df)[0] == ("771", "Mountain-100 Silver, 38", "Mountain Bikes", "3399.9900")


def test_header_row_names_and_types(spark, put, rows):
    df = rowsets.delimited(spark, put("shop.csv", SHOP), header_row=True)
    assert df.dtypes == [("product_id", "int"), ("product_name", "string"), ("list_price", "double")]
    assert rows(df) == WIDGETS


def test_first_row_skipped_in_every_file(spark, put, path, rows):
    put("a.csv", SHOP)
    put("b.csv", SHOP)
    schema = "id INT, name STRING, price DOUBLE"
    df = rowsets.delimited(spark, f"{path}/*.csv", schema=schema, first_row=2)
    assert rows(df) == sorted(WIDGETS * 2)
    unnamed = rowsets.delimited(spark, f"{path}/a.csv", first_row=2)
    assert unnamed.columns == ["C1", "C2", "C3"] and rows(unnamed) == WIDGETS
    with pytest.raises(ValueError):
        rowsets.delimited(spark, path, first_row=3)


def test_inner_quotes_are_doubled(spark, put, rows):
    df = rowsets.delimited(spark, put("q.csv", '1,"say ""hi"", ok"\n'), schema="id INT, t STRING")
    assert rows(df) == [(1, 'say "hi", ok')]


def test_row_terminator_and_encoding(spark, path, rows):
    os.makedirs(path)
    with open(f"{path}/latin.txt", "wb") as file:
        file.write("1;caf\xe9|2;th\xe9|".encode("latin-1"))
    df = rowsets.delimited(
        spark, path, schema="id INT, t STRING", field_terminator=";", row_terminator="|", encoding="ISO-8859-1"
    )
    assert rows(df) == [(1, "caf\xe9"), (2, "th\xe9")]


def test_schema_override_nulls_a_price_that_does_not_fit(spark, put, rows):
    file = put("p.csv", "id,name,price\n1,a,999.99\n2,b,1000.00\n")
    df = rowsets.delimited(spark, file, schema="id INT, name STRING, price DECIMAL(5,2)", first_row=2)
    assert rows(df) == [(1, "a", Decimal("999.99")), (2, "b", None)]


def test_path_patterns(spark, put, path):
    put("file1.csv", "1\n")
    put("file2.csv", "2\n")
    put("other.csv", "4\n")
    put("sub/file3.csv", "8\n")
    put("sub/deep/x.csv", "16\n")

    def total(pattern):
        return rowsets.delimited(spark, f"{path}/{pattern}", schema="n INT").agg(F.sum("n")).first()[0]

    assert [total(p) for p in ("file1.csv", "file*.csv", "*.csv", "*", "**")] == [1, 3, 7, 7, 31]


def test_documents_one_per_file_or_separated(spark, put, path, rows):
    put("a.json", '{\n "product_id": 123,\n "product_name": "Widget",\n "list_price": 12.99\n}')
    put("b.json", '{"product_id":124,"product_name":"Gadget"}\x0b{"product_id":125,"product_name":"Thing"}')
    docs = rowsets.documents(spark, f"{path}/*.json")
    df = docs.select(json_value(F.col("doc"), "$.product_name"), json_value(F.col("doc"), "$.list_price"))
    assert rows(df) == [("Gadget", None), ("Thing", None), ("Widget", "12.99")]


@pytest.mark.parametrize(
    "doc, at, expected",
    [
        ('{"a": {"b": 1}}', "$.a", None), ('{"a": [1, 2]}', "$.a", None), ('{"a": [1, 2]}', "$.a[1]", "2"),
        ('{"a": "[text"}', "$.a", "[text"), ('{"a": "{}"}', "$.a", "{}"), ('{"a": null}', "$.a", None),
        ('{"a": true}', "$.a", "true"), ("{broken", "$.a", None), ('{"a": ""}', "$.a", ""), (None, "$.a", None),
    ],
)
def test_json_value_is_scalar_only(spark, doc, at, expected):
    df = spark.createDataFrame([(doc,)], "doc string")
    assert df.select(json_value(F.col("doc"), at)).first()[0] == expected


def test_split_name_of_one_or_many_words(spark, rows):
    df = spark.createDataFrame([("Ann Lee",), ("Cher",), ("A B C",), (None,)], "Name string")
    assert rows(split_name(df, "Name")) == sorted(
        [("Ann", "Lee"), ("Cher", None), ("A", "B"), (None, None)], key=repr
    )


def test_filepath_reads_only_matching_files(spark, path, rows):
    spark.range(8).selectExpr("id", "2020 + id % 2 AS year", "1 + id div 2 AS month").write.partitionBy(
        "year", "month"
    ).parquet(path)
    pattern = f"{path}/year=*/month=*/*"
    df = spark.read.parquet(path).where((filepath(pattern, 1) == "2020") & filepath(pattern, 2).isin("1", "2"))
    assert rows(df.select("id")) == [(0,), (2,)]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() in (0, 2)
    df.collect()
    assert scan.metrics().apply("numFiles").value() == 2


def test_leaf_folder_with_and_without_its_columns(spark, path):
    spark.range(4).selectExpr("id", "2020 + id % 2 AS Year").write.partitionBy("Year").parquet(path)
    assert rowsets.partition_folder(spark, path, "Year=2020").columns == ["id", "Year"]
    bare = rowsets.partition_folder(spark, path, "Year=2020", keep_columns=False)
    assert bare.columns == ["id"] and bare.count() == 2


def test_named_sources_and_formats(spark, path, database, rows):
    lake = Lake(spark)
    lake.create_source("files", path)
    lake.create_format("Pipes", delimited_format("|", "'"))
    lake.create_format("ParquetFormat", parquet_format())
    with pytest.raises(ValueError):
        lake.create_source("files", "/elsewhere")
    df = spark.createDataFrame([(1, "it's | here"), (2, None)], "id int, t string")
    lake.write(df, "text", "files", "Pipes")
    assert rows(lake.read("text", "files", "Pipes", schema="id int, t string")) == rows(df)
    assert rows(lake.external_table(f"{database}.t", "id int, t string", "text", "files", "Pipes")) == rows(df)
    assert lake.path("/full/path") == "/full/path"

    stored = lake.table_as_select(df, f"{database}.stored", "stored", "files", "ParquetFormat")
    assert rows(stored) == rows(df)
    assert any(name.endswith(".snappy.parquet") for name in os.listdir(f"{path}/stored"))
    spark.sql(f"DROP TABLE {database}.stored")
    with pytest.raises(Exception, match="(?i)exist"):
        lake.table_as_select(df, f"{database}.stored", "stored", "files", "ParquetFormat")


def test_filepath_in_folders_with_blanks_and_percent_signs(spark, path, rows):
    for name in ("my dir", "50%+1"):
        spark.range(2).write.parquet(f"{path}/{name}/year=2020")
    df = spark.read.parquet(f"{path}/my dir/year=2020", f"{path}/50%+1/year=2020")
    found = df.select(filepath("/*/year=*/*.parquet", 1).alias("a"), filepath("/my dir/year=*/*", 1).alias("b")).distinct()
    assert rows(found) == sorted([("my dir", "2020"), ("50%+1", None)], key=repr)
