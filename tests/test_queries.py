"""Every registered query equals its SQL on the smallest data set."""

import oracle
import pytest

import __spark_entry__ as entry
from vacancylens.workload.oracles import ORACLES as SQL
from vacancylens.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    assert oracle.spark_rows(QUERIES[name](spark, SF)) == oracle.duck_rows(duck, SQL[name])


def test_entry(spark):
    assert entry.entry(spark).columns == ["technology", "n", "share"]
