"""Every registered query against its SQL twin, over the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from checks import registered, sql  # noqa: E402
from checks.compare import connect, difference  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def twin():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(sql.ORACLE) == set(registered.QUERIES)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query_equals_its_twin(spark, twin, name):
    df = registered.QUERIES[name](spark, SF_DIR)
    assert difference(df, twin.sql(sql.ORACLE[name])) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registered.QUERIES) <= set(__spark_entry__.queries())
    assert set(registered.QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
