"""Every registered query against its SQL on the same tables."""

import datetime as dt
import math
import re
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA

DIR = os.environ.get("ROWLOOM_SF_DIR", DATA)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [n for n in sorted(entry.oracle_sql()) if not re.match(r"op\d+_|pipeline", n)])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    sql = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in sql.description]
    assert sorted(names) == sorted(df.columns)
    expected = rows_of(names, sql.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(found) == len(expected)
    assert found == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 100
