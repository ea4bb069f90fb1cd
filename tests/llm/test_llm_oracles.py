"""The operators' queries that SQL can express give what DuckDB gives on the smallest tables; all run there."""

import duckdb
import pytest

from folioforge.llm import catalog

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    assert ours
    if name in catalog.ORACLES:
        c = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "conversations"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        theirs = c.execute("SELECT " + ", ".join(f'"{x}"' for x in columns) + f" FROM ({catalog.ORACLES[name]})").fetchall()
        assert sorted(ours, key=str) == sorted(theirs, key=str)
