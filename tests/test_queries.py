"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from crowdspark.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message = check.compare(spark, con, name, SF_DIR)
    # an empty result is right only if the SQL's is empty too
    assert ok or message == "0 rows", message


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
