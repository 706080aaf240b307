"""Every named query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from checks.compare import connect, differences
from checks.registry import QUERIES
from checks.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()
