"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver smoke entry."""

import duckdb
import pytest

import __spark_entry__ as entry
from tickcast.plans import queries as reference

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(None if v != v else v for v in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["symbol", "date"] and df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(reference.queries()) == set(reference.oracle_sql())
    assert set(reference.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(reference.queries()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
