"""Every registered query against its SQL twin, or at least to its end."""

import pytest

from compare import connect, difference
from tickloom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(name, spark, sf_dir):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    assert not any(isinstance(v, float) and v != v for row in rows for v in row)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
