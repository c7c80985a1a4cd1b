"""Every registered query against its DuckDB oracle at sf0.01 (row count,
column names, order-insensitive value hash), like the driver's check."""

import pytest

from cohortkit.plans.compare import compare, duck
from cohortkit.plans.registry import REGISTRY

from .conftest import SF001

WITH_SQL = sorted(n for n, q in REGISTRY.items() if q.sql)
ROWS_ONLY = sorted(n for n, q in REGISTRY.items() if not q.sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    r = compare(q.spark(spark, SF001), q.sql, con)
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, name):
    assert REGISTRY[name].spark(spark, SF001).take(1)
