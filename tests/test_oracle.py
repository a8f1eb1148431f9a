"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

from harness import compare, duck
from roomrate.oracle_sql import oracle_sql
from roomrate.registry import queries

from conftest import SF_ORACLE, SF_SMALL

QUERIES = queries()
ORACLE = oracle_sql()
JOBS = [k for k in QUERIES if k.startswith("job_")]


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def con_oracle():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, con_small, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con_small, ORACLE[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", JOBS)
def test_job_matches_oracle_sf001(spark, con_oracle, name):
    res = compare(QUERIES[name](spark, SF_ORACLE), con_oracle, ORACLE[name])
    assert res["ok"], res
    assert res["spark_rows"] > 0
