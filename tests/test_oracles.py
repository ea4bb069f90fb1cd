"""Every registered query with SQL gives what DuckDB gives on the smallest tables."""

import duckdb
import pytest

from folioforge.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    theirs = duck.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({catalog.ORACLES[name]})").fetchall()
    key = lambda row: tuple((x is None, str(x)) for x in row)
    assert sorted(ours, key=key) == sorted(theirs, key=key)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DIR).count() > 0
