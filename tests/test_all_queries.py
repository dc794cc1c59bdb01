"""Every registered query against its DuckDB oracle on the smallest scale
(rows-only for the queries without one): the driver's correctness gate,
run inside the test suite."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duckdb_views  # noqa: E402

from tessera.plans.catalog import QUERIES  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    rep = compare(spark, duck, E.queries(), E.oracle_sql(), name, SF_SMALL)
    assert rep["status"] in ("ok", "rows-only"), rep
