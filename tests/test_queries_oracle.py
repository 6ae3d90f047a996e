"""Every registered query with an oracle matches DuckDB on the same parquet
tables (row count, column names, values), as the external gate checks."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import rows_of

from conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF001).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
