"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

from __future__ import annotations

import pytest

from oracle_compare import duck, oracle_digest, spark_digest
from reglink.plans.catalog import ORACLE, QUERIES

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = spark_digest(QUERIES[name](spark, SF_SMALL))
    if name not in ORACLE:
        assert got[0] >= 0
        return
    want = oracle_digest(con, ORACLE[name])
    assert got[1] == want[1], f"columns differ: {got[1]} vs {want[1]}"
    assert got[0] == want[0], f"row count {got[0]} vs {want[0]}"
    assert got[2] == want[2], "values differ"


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
