"""Registered queries against their DuckDB SQL at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from newsloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_duckdb(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted([shown(r[c]) for c in columns] for r in df.collect())
    want = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    assert got == sorted([shown(r[names.index(c)]) for c in columns] for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
