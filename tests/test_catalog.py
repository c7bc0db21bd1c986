"""Every registered query against its SQL, over the whole table."""

import pytest
from compare import duckdb_rows, duckdb_types, spark_rows, spark_types

import __spark_entry__ as driver
from slumberline.plans.catalog import QUERIES
from slumberline.plans.oracle import ORACLE_SQL

SF_DIRS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("sf_dir", SF_DIRS)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    assert spark_types(result) == duckdb_types(ORACLE_SQL[name], sf_dir)
    assert spark_rows(result) == duckdb_rows(ORACLE_SQL[name], sf_dir)


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0
