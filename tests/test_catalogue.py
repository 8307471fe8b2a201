"""Every registered query gives the rows of its SQL, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stocktrail.catalogue import QUERIES
from tests.oracle import compare, connect, types_differ

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df, sql = queries()[name](spark, FOLDER), oracle_sql()[name]
    assert types_differ(df, con, sql) == []
    assert compare(df, con, sql) is None


def test_every_query_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


# The rows of the inventory that the table of contents lists.
INVENTORY = {
    "IO": range(1, 11),
    "P": range(1, 8),
    "F": range(1, 11),
    "J": range(1, 12),
    "A": range(1, 16),
    "W": range(1, 7),
    "S": range(1, 5),
    "X": range(1, 17),
    "M": range(1, 5),
    "L": [n for n in range(1, 27) if n != 5],
    "PIPE": range(1, 11),
    "ST": range(1, 7),
}


def test_every_operator_is_registered():
    covered = {mark for q in QUERIES.values() for mark in q.covers.split()}
    wanted = {f"{group}{n}" for group, numbers in INVENTORY.items() for n in numbers}
    assert wanted - covered == set()
