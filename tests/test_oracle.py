"""Every catalog query against its SQL twin on the whole sf0.01 tables."""

import pytest
from compare import connect, differences
from conftest import MEDIUM

from paperloom.plans.catalog import QUERIES
from paperloom.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def database():
    return connect(MEDIUM)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    assert differences(QUERIES[name](spark, MEDIUM), database, ORACLE[name]) is None
