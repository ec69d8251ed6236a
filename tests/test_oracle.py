"""Every query with a DuckDB twin matches it at sf0.001 (the driver's gate
runs the same comparison at sf0.01)."""

import pytest

from cohortlens.plans.compare import compare, duckdb_connection
from cohortlens.plans.registry import all_queries

from conftest import SF_SMALL

SQL_QUERIES = sorted(n for n, q in all_queries().items() if q.sql is not None)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_duckdb(spark, con, name):
    res = compare(spark, con, all_queries()[name], SF_SMALL)
    assert res["status"] == "match", res
    assert "type_mismatch" not in res, res
