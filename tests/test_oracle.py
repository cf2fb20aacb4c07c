"""Every registered query equals its SQL oracle."""

import pytest

from workload.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None
