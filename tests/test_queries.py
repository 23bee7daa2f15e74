"""Every query with an SQL check, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", CHECKS)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    want = con.execute(CHECKS[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)
