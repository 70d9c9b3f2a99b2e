"""Every registered query against its SQL on the smallest scale."""
import pytest

import __spark_entry__ as entry
from tests.compare import connect, duck_rows, normal, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SF))
    sql_columns, sql_rows = duck_rows(con, entry.oracle_sql()[name])
    assert sorted(columns) == sorted(sql_columns)
    assert normal(columns, rows) == normal(sql_columns, sql_rows)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
