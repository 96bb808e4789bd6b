"""Every registered query against its SQL."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ticklake.contracts import TICKER
from ticklake.plans.catalog import ORACLES, QUERIES

from .oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module", autouse=True)
def users_settings(spark):
    """Queries run compiled, as users run them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    compare(QUERIES[name](spark, SF_DIR), tables, ORACLES[name])


def test_entry(spark):
    df = entry(spark)
    assert df.columns == TICKER.columns and df.count() > 0
