"""Queries equal their SQL at the smallest scale."""

import pytest

from docintake.plans.oracles import ORACLES
from docintake.plans.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got, want = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert got == want
