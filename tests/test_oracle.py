"""Every query with a SQL equivalent gives DuckDB's rows, names and types."""

import math
import re

import duckdb
import pytest
from core_rows import TESTDATA

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "date": "DATE",
}
FOLDER = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def text(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def test_every_query_but_the_fitted_ones_has_sql():
    without = set(driver.queries()) - set(driver.oracle_sql())
    assert all(re.match(r"m(05|06|12|13|15|16)_|op\d+_|pipeline$", name) for name in without)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [names.index(c) for c in df.columns]
    expected = sorted(tuple(text(r[i]) for i in order) for r in cursor.fetchall())
    got = sorted(tuple(map(text, r)) for r in df.collect())
    assert got == expected


def test_entry(spark):
    frame = driver.entry(spark)
    assert len(frame.columns) == 38
    assert frame.count() > 0
