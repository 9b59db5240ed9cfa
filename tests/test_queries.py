"""Every registered query against its checking SQL on the smallest tables."""

import pytest

from grantlens.catalog import CHECKS, QUERIES
from tools.compare import compare, database


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert len(QUERIES) == 187


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, folder, name):
    ok, note, _ = compare(spark, con, folder, name, QUERIES[name], CHECKS[name])
    assert ok, note
