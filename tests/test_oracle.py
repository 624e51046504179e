"""Every query of the library against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from sessiongrain.plans import checked_queries, product_queries, queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    ours = queries.QUERIES[name](spark, sf_dir).toPandas()
    theirs = duck.sql(queries.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    as_rows = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert as_rows(ours) == as_rows(theirs)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs_without_sql(spark, sf_dir, name):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert "turn_assembly" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
