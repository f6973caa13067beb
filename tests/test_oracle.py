"""Every registered query against its SQL on the smallest test tables."""

import os

import oracle
import pytest

from registered import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return oracle.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, name):
    rows, difference = oracle.compare(spark, db, QUERIES[name], SQL[name], SF_DIR)
    assert difference is None
    assert rows > 0 or name == "payments_per_day"


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["date_title", "amount", "date_sort"]
