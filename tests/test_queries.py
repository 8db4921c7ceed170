"""Every registered query against DuckDB on the same tables."""

import subprocess
import sys

import pytest
from conftest import ROOT
from oracle import connect, differences

from millrace.plans.registry import oracle_sql, queries


@pytest.fixture(scope="module")
def duck(folder):
    connection = connect(folder)
    yield connection
    connection.close()


# Estimates differ from engine to engine; tests/test_rollups.py checks this one.
WITHOUT_SQL = {"approx_orders_rollup"}


def test_every_query_has_sql():
    assert queries().keys() - oracle_sql().keys() == WITHOUT_SQL


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, folder, duck, name):
    assert differences(queries()[name](spark, folder), duck, oracle_sql()[name]) is None


def test_entry(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.columns == ["CalendarYear", "CalendarQuarter", "TotalSales"]
    assert result.count() > 0


def test_the_entry_works_without_the_packages_of_other_queries():
    """A missing tokenizer package costs the queries of the subpackage, not the others."""
    code = """
import sys
sys.modules["public_tokenizers"] = sys.modules["zstandard"] = None
import __spark_entry__
from millrace.plans import registry
assert registry.queries().keys() <= __spark_entry__.queries().keys()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr


def test_sorted_queries_come_in_order(spark, folder):
    for name in ("sort_customers", "catalog_scan"):
        ours = queries()[name](spark, folder).toArrow()
        theirs = connect(folder).sql(oracle_sql()[name]).to_arrow_table()
        assert [tuple(r.values()) for r in ours.select(theirs.column_names).to_pylist()] == [tuple(r.values()) for r in theirs.to_pylist()]
