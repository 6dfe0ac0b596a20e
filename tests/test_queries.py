"""Every query that has SQL must give the same rows as that SQL, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    return repr(float(v) + 0.0) if isinstance(v, (int, float)) else str(v)


def sorted_rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, data, sql, name):
    df = entry.queries()[name](spark, data)
    expected = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(names, expected.fetchall())


def test_entry_runs(spark, data):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables are not here")
    assert entry.entry(spark).count() == 5
