"""The queries against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from checks.compare import difference
from tallymart.llm.oracle import ORACLE
from tallymart.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None
