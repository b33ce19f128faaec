"""Every registered query against its SQL."""

import pytest
from oracle_check import compare, connect

from tidemark.catalog import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, REGISTRY[name], allow_empty=True) is None
