"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, open_tables

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, tables, name):
    assert compare(spark, tables, QUERIES[name], ORACLE[name], FOLDER) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).columns
