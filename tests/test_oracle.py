"""Every query of the core equals its DuckDB SQL on sf0.001 (the driver runs
the same check at sf0.01)."""

import pytest

from fairgauge.plans.oracle import oracle_sql
from fairgauge.plans.queries import QUERIES
from tests.compare import compare, duck

from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, d_cols, s_rows, d_rows = compare(df, con, oracle_sql()[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    assert not diff, diff[:2]
