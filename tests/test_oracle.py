"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from comparison import connect, differences

from moonstride.catalog import oracles as oracle_sql
from moonstride.catalog import registered as queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, name, queries()[name], oracle_sql()[name], FOLDER) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["date_day", "activity_count"]
    assert df.count() == 30
