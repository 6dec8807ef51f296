"""Every registered query against its oracle text."""
import pytest
from compare import compare, duck

import __spark_entry__ as entry
from queries import catalogue

QUERIES, ORACLE = catalogue.QUERIES, catalogue.ORACLE


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_all_have_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], sf) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "status" in df.columns
