"""Queries of the training-data operators against their SQL on the smallest test tables."""

import os

import oracle
import pytest

from layerforge.llm import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    rows, difference = oracle.compare(spark, oracle.database(SF_DIR), QUERIES[name], SQL[name], SF_DIR)
    assert difference is None and rows > 0


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
