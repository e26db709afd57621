"""Every registered query with oracle SQL equals DuckDB on the smallest tables."""

import pytest

from sampwise.plans.catalog import ORACLE_SQL, QUERIES
from scripts.check_oracle import compare, duck
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg
