"""Every query against DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()

INTEGER_TYPES = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT"}
SQL_TYPES = INTEGER_TYPES | {"string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})")
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    whole = {column[0] for column in duck.execute(f"DESCRIBE ({ORACLE[name]})").fetchall()}
    assert whole == set(columns)
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == kinds
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert expected, "the oracle has no rows"
    assert ordered(df.select(columns).collect()) == ordered(expected)
