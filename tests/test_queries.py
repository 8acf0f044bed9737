"""Every core query against its SQL on the smallest test data."""

import os

import pytest

from gridwright.plans.registry import collect
from tests.oracle import compare, connect

DATA = os.environ.get("GRIDWRIGHT_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, ORACLES = collect()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    if name in ORACLES:
        compare(df, con, ORACLES[name])
    else:
        assert df.count() >= 0 and df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
