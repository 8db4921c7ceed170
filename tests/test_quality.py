import pytest

from millrace.operators import quality


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "ann"), (1, None), (2, "robert"), (None, "x"), (None, "y")], "id int, name string")


def test_duplicates(people, rows):
    assert rows(quality.duplicate_keys(people, ["id"])) == [(1, 2), (None, 2)]
    with pytest.raises(quality.QualityError):
        quality.require_unique(people, ["id"], "people")
    quality.require_unique(people.where("name = 'ann' OR id IS NULL"), ["id"], "people")


def test_orphans_count_facts_and_include_null(people, spark, rows):
    dimension = spark.createDataFrame([(1,), (1,)], "key int")
    assert rows(quality.orphan_keys(people, "id", dimension, "key")) == [(2, 1), (None, 2)]


def test_nulls_and_lengths(people, rows):
    assert rows(quality.null_counts(people, ["id", "name"])) == [("id", 2), ("name", 1)]
    assert rows(quality.length_violations(people, {"name": 3})) == [("name", 3, 1)]


def test_decimal_fit(spark, rows):
    df = spark.createDataFrame([("999.99",), ("1000",), ("abc",), (None,)], "v string")
    assert rows(df.select("v", quality.fits_decimal("v", 5, 2))) == [
        ("1000", False), ("999.99", True), ("abc", False), (None, True),
    ]
