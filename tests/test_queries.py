"""Every registered query against its SQL on the same Parquet files."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

NAMES = sorted(contract.queries())


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def same(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(same(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, float)
                                           else (True, "num", round(v, 1)) for v in r))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, sf, name):
    df = contract.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    assert got, "no rows"
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = result.fetchall()
    assert len(got) == len(expected)
    for g, e in zip(rows_of(df.columns, got), rows_of(names, expected)):
        for a, b in zip(g, e):
            if isinstance(a, float) and isinstance(b, float):
                assert a == pytest.approx(b, rel=1e-9, abs=1e-9), (g, e)
            else:
                assert a == b and isinstance(a, bool) == isinstance(b, bool), (g, e)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["has_positive", "avg_length", "review_count", "avg_words"]
    assert df.count() > 0
