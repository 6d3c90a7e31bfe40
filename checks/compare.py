"""Run registered queries on Spark and their SQL on DuckDB and compare all rows.

    python -m checks.compare [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from .oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    for types, name in (
        (int, "int"), (float, "float"), (decimal.Decimal, "decimal"),
        (datetime.date, "date"), (str, "str"),
    ):
        if isinstance(value, types):
            return name
    return "null" if value is None else type(value).__name__


def _key(row: tuple) -> tuple:
    return tuple((value is not None, _kind(value), value) for value in row)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between both results, or None."""
    got_rows = [tuple(row) for row in df.collect()]
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = rows_of(df.columns, got_rows)
    want = rows_of(columns, found.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "both results are empty"
    for mine, theirs in zip(got, want):
        if mine != theirs or [_kind(v) for v in mine] != [_kind(v) for v in theirs]:
            return f"{mine} != {theirs}"
        if any(isinstance(v, float) and math.isnan(v) for v in mine):
            return f"not a number in {mine}"
    return None


def main(argv: list[str]) -> int:
    from tallymart.session import local_session

    from .catalog import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = local_session("compare"), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
