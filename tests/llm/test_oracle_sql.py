"""The training-data queries that SQL can express, against DuckDB on the smallest tables."""

import pytest

from sampwise.llm.queries import ORACLE_SQL, QUERIES
from scripts.check_oracle import duck, normalise
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(ORACLE_SQL[name])
    want = normalise(list(rel.columns), rel.fetchall())
    assert normalise(df.columns, [tuple(r) for r in df.collect()]) == want


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
