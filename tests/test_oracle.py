"""Every registered query with an oracle must equal its DuckDB SQL on the driver's tables."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck_connect
from wordloom.plans.catalog import oracle_sql, queries

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, queries()[name], oracle_sql()[name], SF_SMALL, con)
    assert r["ok"], r


def test_catalogue_complete():
    q = queries()
    assert len(q) == 67 and len(oracle_sql()) == 64
