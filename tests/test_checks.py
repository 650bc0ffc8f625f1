"""Every registered query against its SQL."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.registry import CHECKS
from compare import TESTDATA, differences, duck

LOCATION = f"{TESTDATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(LOCATION), reason="no generated tables")


@pytest.fixture(scope="module")
def con():
    return duck(LOCATION)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows_as_sql(spark, con, name):
    assert differences(spark, con, name, LOCATION) == []


def test_every_check_is_registered():
    assert CHECKS.keys() <= queries().keys()
    assert CHECKS.keys() <= oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() > 0
