"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

from checks.catalog import QUERIES
from checks.compare import connect, difference
from checks.oracle import ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_equal(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None
