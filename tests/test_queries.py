"""Every registered query of the core library against its SQL oracle on the smallest tables."""

import pytest
from conftest import SMALL
from oracle_check import connect, differences

from sensorloom.plans import streams  # noqa: F401  registers the streaming queries
from sensorloom.plans.oracle import ORACLE
from sensorloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, oracle, name):
    assert differences(QUERIES[name](spark, SMALL), oracle, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() >= 0
