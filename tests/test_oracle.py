"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import pytest
from harness import compare, connect

from presslens.plans import ORACLES, QUERIES

SF = os.environ.get("PRESSLENS_TEST_SF", "0.001")
DIRECTORY = f"/root/testdata/sf{SF}"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    assert compare(QUERIES[name](spark, DIRECTORY), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows_and_the_published_columns(spark):
    import __spark_entry__ as contract

    frame = contract.entry(spark)
    assert frame.columns[:6] == ["date", "location", "count_articles", "admin_level", "language", "cv"]
    assert frame.columns[-1] == "kw"
    assert frame.limit(1).count() == 1
