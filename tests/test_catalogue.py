"""Every query of the catalogue against its twin in SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from storyloom.plans import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DIR)
    if name not in catalogue.ORACLES:
        got.collect()
        return
    want = duck.sql(catalogue.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda all_rows, names: sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in all_rows), key=repr)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry.entry(spark).count() == 30
    assert set(entry.oracle_sql()) <= set(entry.queries())
